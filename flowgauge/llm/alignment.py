"""Alignment of two tokenizers' tokens of the same texts, and how often which ids overlap in the corpus."""

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain, islice, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.encoding import is_joined
from flowgauge.llm.tables import stored
from flowgauge.llm.turns import release, take_turn

#: Characters that are cut, and that go through the tokenizers, together; characters and different windows that a block of texts may hold.
AT_ONCE, IN_CALL, BLOCK_CHARS, BLOCK_WINDOWS = 1 << 20, 1 << 16, 1 << 24, 300_000
#: Words whose ids a worker remembers from block to block.
REMEMBERED = 150_000
#: Stands between the ids of a window's two sides; no id of a vocabulary of up to 65,535 tokens.
_BETWEEN = 0xFFFF
_MARK = _BETWEEN.to_bytes(2, "little")
#: How pieces write a space: a fixed value.
_SPACE = "▁"
#: A space before white space.
_BESIDE = re.compile(r" \s")
_DOC = "doc_id long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_FIRST = f"{_DOC}, windows binary, lens binary, links binary, pair long, n long"
_LAST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Alignment(NamedTuple):
    """``documents``: a row per document; ``pairs``: a_id, b_id, count, best of every pair of ids that is linked anywhere."""

    documents: DataFrame
    pairs: DataFrame


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids of a byte-level tokenizers file, of a text with a space put before it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters, vocabulary = _byte_letters(), self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            self.bytes[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.by_word = is_joined(path)

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]


class Pieces:
    """Ids of a sentencepiece model, which puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = model.id_to_piece(list(range(model.get_piece_size())))
        self.bytes = [
            bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace(_SPACE, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        # No piece has a space behind another letter: none is joined across the place before a word's space.
        self.by_word = not any(_SPACE in piece.lstrip(_SPACE) for piece in pieces)

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class BothSides:
    """Ids on both sides, as bytes of 16-bit integers, of whole texts and of words that are remembered.

    Neither tokenizer joins across the place before a space that has no other white space around it. A text whose
    spaces are all like that has the ids of its words, one after the other; a word goes through both tokenizers once.
    """

    def __init__(self, a_path: str, b_path: str):
        self.sides = ByteLevel(a_path), Pieces(b_path)
        self.tokens = [side.bytes for side in self.sides]
        if max(map(len, self.tokens)) > _BETWEEN:
            raise ValueError(f"vocabularies of up to {_BETWEEN} tokens only")
        self.by_word = all(side.by_word for side in self.sides)
        self.places: dict[str, int] = {}  # of words in the lists below
        self.known: list[bytes] = []  # ids of both sides with a mark between them, or none

    def together(self, texts: list[str]) -> list[list[bytes]]:
        """Ids by side and text; empty where a side's tokens aren't space and text."""
        calls = np.cumsum([0, *map(len, texts)]) // IN_CALL
        bounds = [0, *(np.flatnonzero(np.diff(calls)) + 1).tolist(), len(texts)]
        both: list[list[bytes]] = [[], []]
        for start, end in pairwise(bounds):
            for side, ids in zip(both, self._called(texts[start:end]), strict=True):
                side += ids
        return both

    def _called(self, texts: list[str]) -> list[list[bytes]]:
        out = [[array("H", ids) for ids in side(texts)] for side in self.sides]
        first, second = ([b"".join(map(t.__getitem__, ids)) for ids in o] for t, o in zip(self.tokens, out, strict=True))
        good = [x == y == f" {text}".encode() for x, y, text in zip(first, second, texts, strict=True)]
        return [[o.tobytes() if g else b"" for o, g in zip(side, good, strict=True)] for side in out]

    def words(self, texts: list[str]) -> list[list[int] | None]:
        """Places of each text's words among those known; null for a text that has to go through as a whole."""
        cut = [
            text.split(" ") if self.by_word and text and text[0] != " " != text[-1] and not _BESIDE.search(text) else None
            for text in texts
        ]
        fresh = list({w for some in cut if some for w in some}.difference(self.places))
        self.places.update(zip(fresh, range(len(self.places), len(self.places) + len(fresh)), strict=True))
        self.known += [a and a + _MARK + b for a, b in zip(*self.together(fresh), strict=True)]
        return [some and list(map(self.places.__getitem__, some)) for some in cut]

    def forget(self) -> None:
        """Keep the words that came first, as they are the most frequent."""
        if len(self.places) > REMEMBERED:
            self.places = dict(islice(self.places.items(), REMEMBERED))
            del self.known[REMEMBERED:]


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _sides(keys: list[bytes]) -> list[list[bytes]]:
    """The ids of both sides, of keys that hold them."""
    ends = np.cumsum([0, *map(len, keys)])
    marks = 2 * np.flatnonzero(np.frombuffer(b"".join(keys), np.uint16) == _BETWEEN) - ends[:-1]
    at = marks.tolist()
    return [[key[:m] for key, m in zip(keys, at, strict=True)], [key[m + 2 :] for key, m in zip(keys, at, strict=True)]]


class _Numbers(dict):
    """Numbers of windows by their ids, in order of their first coming."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


class Aligner:
    """Aligns texts by windows between verified shared ends, each different window once.

    A window begins where a token of either side ends and the next ones of both begin with a space, or with the text. Its ids
    of both sides are the key under which its groups and links are remembered for the rest of a block. Words that neither
    tokenizer joins with others are windows; their numbers are remembered too.
    """

    def __init__(self, a_path: str, b_path: str):
        self.encode = BothSides(a_path, b_path)
        sides = self.encode.tokens
        self.length = [np.array([len(t) for t in side], np.int64) for side in sides]
        self.spaced = [np.array([t[:1] == b" " for t in side]) for side in sides]
        # Ids as text with the mark behind them: within a side, and at its end.
        self.names = [
            (np.array([f"{i}," for i in range(len(side))], object), np.array([f"{i}{mark}" for i in range(len(side))], object))
            for side, mark in zip(sides, "|;", strict=True)
        ]
        self.clear()

    def clear(self) -> None:
        """Forget all windows: a new block begins."""
        self.encode.forget()
        self.numbers = _Numbers()
        self.of_place = np.full(len(self.encode.places), -1)  # window of each word; -1 if not met in this block
        self.texts: list[str] = []  # groups of each window, as text
        self.links: list[np.ndarray] = []  # of the windows learned together, a << 16 | b
        self.learned: list[int] = []  # how many those are
        self.sizes = np.zeros((4, 1024), np.int64)  # n_a, n_b, n_groups, n_links by window
        self.counts = np.zeros(1024, np.int64)  # windows in texts

    def _grow(self) -> None:
        short = len(self.numbers) - len(self.counts)
        if short > 0:
            more = max(short, len(self.counts))
            self.sizes = np.pad(self.sizes, ((0, 0), (0, more)))
            self.counts = np.pad(self.counts, (0, more))

    def align(self, texts: list[str]) -> list[tuple[np.ndarray, str] | None]:
        """(numbers of a text's windows, its groups' sha256), or null for a text without tokens on either side."""
        known, places = self.encode.known, self.encode.words(texts)
        flat = np.fromiter(chain.from_iterable(some for some in places if some), np.int64)
        self.of_place = np.pad(self.of_place, (0, len(known) - len(self.of_place)), constant_values=-1)
        met = np.unique(flat)
        # A word is a window, as both sides end before its space.
        fresh = [p for p in met[self.of_place[met] == -1].tolist() if known[p]]
        before, numbers = len(self.numbers), [self.numbers[known[p]] for p in fresh]
        self.of_place[fresh] = numbers
        fresh = [p for p, number in zip(fresh, numbers, strict=True) if number >= before]
        for p, (number,) in zip(fresh, self._windows(_sides([known[p] for p in fresh]), before), strict=True):
            self.of_place[p] = number
        # Words that aren't their tokens are left without a window; so are texts whose words may be joined.
        numbers, found, begin = self.of_place[flat], [], 0
        for some in places:
            found.append(None if some is None else numbers[begin : begin + len(some)])
            begin += len(some or ())
        whole = [i for i, f in enumerate(found) if texts[i] and (f is None or f.min() < 0)]
        ids = self.encode.together([texts[i] for i in whole])
        for i, f in zip(whole, self._windows(ids, len(self.numbers)), strict=True):
            found[i] = f
        out: list = [None] * len(texts)
        for i, mine in enumerate(found):
            if mine is not None and len(mine):
                groups = "".join(map(self.texts.__getitem__, mine.tolist()))[:-1]
                out[i] = mine, hashlib.sha256(groups.encode()).hexdigest()
                np.add.at(self.counts, mine, 1)
        return out

    def _windows(self, lists: list[list[bytes]], known: int) -> list[np.ndarray]:
        """Numbers of the windows of texts, given by their ids on both sides; none for a text without ids.

        Groups and links of the first ``known`` windows are there already.
        """
        out = [np.zeros(0, np.int64)] * len(lists[0])
        good = [i for i, ids in enumerate(lists[0]) if ids]
        if not good:
            return out
        a, b = (np.frombuffer(b"".join([side[i] for i in good]), np.uint16) for side in lists)
        ends_a, ends_b = np.cumsum(self.length[0][a]), np.cumsum(self.length[1][b])
        ended = np.zeros((2, ends_a[-1] + 1), bool)
        ended[0, ends_a] = ended[1, ends_b] = True
        # Last tokens of groups on both sides; texts end together, so no group runs over two of them.
        last_a, last_b = np.nonzero(ended[1, ends_a])[0], np.nonzero(ended[0, ends_b])[0]
        text_ends = ends_a[np.cumsum([len(lists[0][i]) // 2 for i in good]) - 1]
        cut = np.append(self.spaced[0][a[last_a[:-1] + 1]] & self.spaced[1][b[last_b[:-1] + 1]], True)
        cut[np.searchsorted(ends_a[last_a], text_ends)] = True
        end_a, end_b = last_a[cut] + 1, last_b[cut] + 1
        start_a, start_b = np.append(0, end_a[:-1]), np.append(0, end_b[:-1])
        # Both sides' ids of a window in one stretch, with a mark between them.
        keys = np.full(len(a) + len(b) + len(end_a), _BETWEEN, np.uint16)
        nth = np.arange(len(end_a))
        keys[np.arange(len(a)) + np.repeat(start_b + nth, end_a - start_a)] = a
        keys[np.arange(len(b)) + np.repeat(end_a + nth + 1, end_b - start_b)] = b
        bounds, flat = (2 * (end_a + end_b + nth + 1)).tolist(), keys.tobytes()
        number_of = self.numbers.__getitem__
        numbers = np.array([number_of(flat[s:e]) for s, e in zip([0, *bounds[:-1]], bounds, strict=True)], np.int64)
        if len(self.numbers) > known:
            first = np.unique(numbers, return_index=True)[1]
            fresh = np.sort(first[numbers[first] >= known])  # in the order of their numbers
            self._learn(a, b, ends_a, ends_b, start_a[fresh], end_a[fresh], start_b[fresh], end_b[fresh], ended)
        begin = 0
        for i, end in zip(good, np.searchsorted(ends_a[end_a - 1], text_ends, "right").tolist(), strict=True):
            out[i], begin = numbers[begin:end], end
        return out

    def _learn(self, a, b, ends_a, ends_b, start_a, end_a, start_b, end_b, ended) -> None:
        """Groups and links of windows not met before."""
        self._grow()
        at = slice(len(self.texts), len(self.texts) + len(start_a))
        n_a, n_b = end_a - start_a, end_b - start_b
        in_a, in_b = _spans(start_a, n_a), _spans(start_b, n_b)
        # A token's partners are those that end behind its start and start before its end.
        low = np.searchsorted(ends_a, ends_b[in_b] - self.length[1][b[in_b]], "right")
        high = np.searchsorted(ends_a, ends_b[in_b], "left") + 1
        partners = high - low
        links = a[_spans(low, partners)].astype(np.uint32) << 16 | np.repeat(b[in_b], partners)
        n_links = np.add.reduceat(partners, np.cumsum(n_b) - n_b)
        closes_a, closes_b = ended[1, ends_a[in_a]], ended[0, ends_b[in_b]]
        n_groups = np.add.reduceat(closes_a.astype(np.int64), np.cumsum(n_a) - n_a)
        self.sizes[:, at] = n_a, n_b, n_groups, n_links
        # Text of groups: by the group of a token, A before B, in order.
        group = np.concatenate([np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b])
        words = np.concatenate(
            [np.where(closes_a, self.names[0][1][a[in_a]], self.names[0][0][a[in_a]]), np.where(closes_b, self.names[1][1][b[in_b]], self.names[1][0][b[in_b]])]
        )
        words = words[np.argsort(group, kind="stable")].tolist()
        begin = 0
        for end in np.cumsum(n_a + n_b).tolist():
            self.texts.append("".join(words[begin:end]))
            begin = end
        self.links.append(links)
        self.learned.append(len(start_a))

    def summary(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The block's different pairs and how often each is linked; links by window and, as places in the pairs, the links."""
        n_links = self.sizes[3, : len(self.texts)]
        pairs = np.unique(np.concatenate([np.zeros(0, np.uint32), *map(np.unique, self.links)]))
        counts, places = np.zeros(len(pairs), np.int64), np.zeros(n_links.sum(), "<u4")
        begin = window = 0
        # A part of the windows at a time, as the pairs are few beside the links.
        for links, windows in zip(self.links, self.learned, strict=True):
            some = places[begin : begin + len(links)]
            some[:] = np.searchsorted(pairs, links)
            np.add.at(counts, some, np.repeat(self.counts[window : window + windows], n_links[window : window + windows]))
            begin, window = begin + len(links), window + windows
        return pairs.astype(np.int64) >> 16 << 32 | pairs & 0xFFFF, counts, n_links, places


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    """This process's aligner of two tokenizer files."""
    take_turn("alignment", _aligners.clear)
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


_NAMES = ["doc_id", "block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "windows", "lens", "links", "pair", "n"]
_TYPES = [pa.int64()] * 6 + [pa.string()] + [pa.binary()] * 3 + [pa.int64()] * 2


def _batch(n: int, columns: dict) -> pa.RecordBatch:
    arrays = [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(_NAMES, _TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _encoder(a_path: str, b_path: str):
    def closed(aligner: Aligner, block: int) -> Iterator[pa.RecordBatch]:
        pairs, counts, n_links, places = aligner.summary()
        dictionary = {"block": [block], "lens": [n_links.astype("<u4").tobytes()], "links": [places.tobytes()]}
        yield _batch(1, dictionary)
        for start in range(0, len(pairs), 1 << 16):
            some = pairs[start : start + (1 << 16)]
            yield _batch(len(some), {"block": [block] * len(some), "pair": some, "n": counts[start : start + (1 << 16)]})
        aligner.clear()
        release()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = _aligner(a_path, b_path)
        aligner.clear()
        block, chars = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            begin = 0
            while begin < len(ids):
                end, total = begin + 1, sizes[begin]
                while end < len(ids) and total + sizes[end] <= AT_ONCE:
                    total += sizes[end]
                    end += 1
                found = aligner.align([t or "" for t in texts.slice(begin, end - begin).to_pylist()])
                none = np.zeros(0, np.int64)
                windows = [f[0] if f else none for f in found]
                sums = np.array([aligner.sizes[:, w].sum(axis=1) for w in windows]).reshape(-1, 4).T
                row = dict(zip(("n_a", "n_b", "n_groups", "n_links"), sums, strict=True)) | {
                    "doc_id": ids[begin:end],
                    "block": [block] * (end - begin),
                    "groups_sha256": [f[1] if f else "" for f in found],
                    "windows": [w.astype("<u4").tobytes() for w in windows],
                }
                yield _batch(end - begin, row)
                begin, chars = end, chars + total
                if chars >= BLOCK_CHARS or len(aligner.numbers) >= BLOCK_WINDOWS:
                    yield from closed(aligner, block)
                    block, chars = block + 1, 0
        yield from closed(aligner, block)

    return encode


def _summer(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of the corpus-wide counts over the links of each of a block's documents."""
    values = np.zeros((2, right.num_rows), np.int64)
    # The block's pairs in their order are the places that links name.
    order = np.argsort(right.column("pair").to_numpy(), kind="stable")
    values[0] = right.column("count").to_numpy()[order]
    values[1] = right.column("best").to_numpy(zero_copy_only=False)[order]
    kind = np.array(left.column("lens").is_valid().to_pylist(), bool)
    dictionary, docs = left.filter(pa.array(kind)), left.filter(pa.array(~kind))
    lens = np.frombuffer(b"".join(dictionary.column("lens").to_pylist()), "<u4").astype(np.int64)
    links = np.frombuffer(b"".join(dictionary.column("links").to_pylist()), "<u4")
    sums = np.zeros((2, len(lens)), np.int64)
    if len(lens):
        sums[:] = np.add.reduceat(values[:, links], np.cumsum(lens) - lens, axis=1)
    found = np.array([sums[:, np.frombuffer(w.as_buffer(), "<u4")].sum(axis=1) for w in docs.column("windows")], np.int64)
    found = found.reshape(-1, 2).T
    columns = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    columns |= {"n_best": pa.array(found[1]), "count_sum": pa.array(found[0]), "groups_sha256": docs.column("groups_sha256")}
    return pa.table(columns)


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str) -> Alignment:
    """Where the tokens of two tokenizers overlap, per document and over all ``docs`` (doc_id, text).

    A is a byte-level file of the tokenizers library, given a space and the text; B a sentencepiece model, given the text.
    Special tokens' strings in texts are plain text. Byte offsets where tokens of both end cut the tokens into groups; a
    link is a pair of tokens, one of each side, whose byte ranges overlap; a pair of ids counts as often as it is linked
    in the corpus. Per document: n_a, n_b, n_groups, n_links; n_best, links whose count is the highest of their B id, ties
    included; count_sum, the counts of its links; groups_sha256, of ``a1,a2|b1;a3|b2`` with the groups in order.

    Texts that are null or empty, or whose bytes by either side aren't space and text, have zeros and ''. Rows that repeat
    a doc_id, or have none, are rows of their own, and texts that repeat count as often as they come. An empty table gives
    empty tables. Other columns are not read.

    One pass over the texts, in place, tokenises them whole and writes each block's window numbers, windows and pair counts.
    Pair counts are summed over blocks; every block asks once for each of its different pairs, so that a pair that
    is everywhere is one row a block. A block holds at most ``BLOCK_CHARS`` of text and some ``BLOCK_WINDOWS`` windows, or one
    longer text.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = stored(read.mapInArrow(_encoder(a_path, b_path), _FIRST), "alignment")
    asked = first.where("pair is not null").select("block", "pair", "n")
    pairs = asked.groupBy("pair").agg(F.sum("n").alias("count"))
    # A B id has at most as many rows here as A has ids.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    pairs = stored(pairs.withColumn("best", F.col("count") == F.max("count").over(of_b)), "pairs")
    answers = asked.select(F.col("block").alias("of"), "pair").join(pairs, "pair")
    rows = first.where("pair is null").drop("pair", "n")
    documents = rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_summer, _LAST)
    a_id, b_id = F.shiftright("pair", 32).cast("int"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int")
    # Pairs of texts that were left out may be listed without a link.
    return Alignment(documents, pairs.where("count > 0").select(a_id.alias("a_id"), b_id.alias("b_id"), "count", "best"))
