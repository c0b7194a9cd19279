"""Token ids of whole texts, by remembering those of the stretches that a tokenizer never joins."""

import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain, compress, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from flowgauge.llm.turns import take_turn

#: Stretches that a worker remembers, and the longest of them. Beyond, the three quarters that came first stay: the most frequent.
REMEMBERED, LONGEST = 500_000, 48
#: Words that go through the tokenizer as one text; bytes of text that are cut, and texts whose ids are put, together.
AT_ONCE, BYTES, TOGETHER = 256, 1 << 21, 64
#: Places before a space that a word follows.
_WORD_STARTS = re.compile(r"(?= \S)")
#: Letters, a line end before them or not, and marks of ASCII behind them: none that begins a contraction or special token.
_WORD = re.compile(r"(\n?[^\W\d_]+)([!-&(-/:;=-@\[-^`{-~]+)")
#: A mark behind an ASCII letter that ends a cut. It is cut off too, and goes by these line ends before it: no other cut has two.
_LAST_MARK, _OFF = re.compile(r"([.,])(?= |\Z)(?<=[A-Za-z].)"), "\n\n"
#: How vocabularies write the space before a word and the end of a word: fixed values.
_SPACE, _WORD_END = "Ġ", "</w>"


def _stays_word(word: str) -> bool:
    """Whether the word is letters alone after normalisation too; else it would grow together with the marks behind it."""
    return word.isascii() or unicodedata.normalize("NFC", word.lower()).strip().isalpha()


class _Known(dict):
    """Numbers of stretches, in order of their first coming. One not known yet is put down as fresh, to be filled before use."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, cut: str) -> int:
        self.fresh.append(cut)
        self[cut] = number = len(self)
        return number


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, the same as one call of the tokenizer on the whole text gives.

    ``joined`` tokenizers (byte level, a word holds the space before it) never join across the place before a space
    that a word follows, nor around a line end between words; others, which drop white space, never across a space or line
    end. Texts are cut there and the cuts are encoded once each, as most words come again and again: Arrow finds the
    different cuts of some texts, and only those are looked up among the remembered ones.

    A cut of a joined tokenizer goes by its text without the space before it; one after a line end begins with that.
    """

    def __init__(self, path: str, joined: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.joined = Tokenizer.from_file(path), joined
        self.known, self.marks = _Known(), {}
        self.learned = 0  # fresh cuts done
        # Where each cut's ids are in the one array of all, and how many; a start below 0: white space behind white space.
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")
        # Where A-Z are the same to the tokenizer as a-z, words are remembered once. "<" may begin a special token.
        self.folds = all((self._ids(chr(c)) == self._ids(chr(c + 32))).all() for c in range(65, 91))
        # Tokens that begin a word with its space, or else that end a word; and the line end.
        vocabulary = self.tokenizer.get_vocab()
        self.edges = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edges[[i for t, i in vocabulary.items() if (t.startswith(_SPACE) if joined else t.endswith(_WORD_END))]] = True
        self.line = self._ids("\n").tobytes()
        self.line_end = int(self._ids("\n")[0]) if joined else -1

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _spaced(self, text: str) -> str:
        """A text with its cuts between spaces; for a joined tokenizer, as if a line end came before it."""
        if self.joined:
            text = f"\n{text[:-1] if self._ends_line(text) else text}".replace("\n", " \n")[1:]
        else:
            if self.folds and "<" not in text:
                text = text.encode().lower().decode()
            text = text.replace("\n", " ")
        return _LAST_MARK.sub(rf" {_OFF}\1", text)

    def _ends_line(self, text: str) -> bool:
        """Whether a line end is the last of the text. Behind a word it is a token by itself."""
        return text[-1:] == "\n" and text[-2:-1].strip() != ""

    def _numbers(self, cuts: pa.Array) -> np.ndarray:
        """The cuts' numbers, all of them filled."""
        coded = cuts.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        met = np.fromiter(map(self.known.__getitem__, different), np.int32, len(different))
        self._learn()
        return met[coded.indices.to_numpy()]

    def _joint(self, numbers: np.ndarray, counts: np.ndarray, skip: int = 0) -> list[bytes]:
        """The ids of texts with so many cuts each, but for the first ``skip``."""
        out, at = [], np.append(0, np.cumsum(counts))
        for first in range(0, len(counts), TOGETHER):
            bounds = at[first : first + TOGETHER + 1]
            some = numbers[bounds[0] : bounds[-1]]
            sizes = self.sizes[some]
            ends = 4 * np.append(0, np.cumsum(sizes))[bounds - bounds[0]]
            ids = self.flat[_spans(self.starts[some], sizes)].tobytes()
            out += [ids[a + 4 * skip : b] for a, b in pairwise(ends.tolist())]
        return out

    def _learn(self) -> None:
        """Fill what is fresh. Plain words go through the tokenizer together, as the words of one text."""
        known, fresh = self.known, self.known.fresh
        base = len(known) - len(fresh)
        words, lines, other, runs, marked, stems, marks = [], [], [], [], [], [], []
        done, sizes, ids = [], [], []
        while self.learned < len(fresh):  # which grows by words of marked cuts
            at, cut = self.learned, fresh[self.learned]
            self.learned += 1
            if cut.isalpha():
                words.append(at)
            elif cut[:2] == _OFF:
                done.append(at)
                ids.append(self._ids(cut[2:]))
                sizes.append(len(ids[-1]))
            elif self.joined and not cut[cut[:1] == "\n" :][:1].strip():
                runs.append(base + at)  # white space behind white space
            elif self.joined and cut[:1] == "\n" and cut[1:].isalpha():
                lines.append(at)
            elif (found := _WORD.fullmatch(cut)) and _stays_word(found[1]):
                marked.append(at)
                stems.append(known[found[1]])
                marks.append(found[2])
            else:
                other.append(at)
        for some, lead in ((words, " "), (lines, "")):
            for start in range(0, len(some), AT_ONCE):
                part = some[start : start + AT_ONCE]
                new = self._ids("".join([lead + fresh[at] for at in part]))
                apart = self._apart(new, bool(lead))
                if len(apart) == len(part):
                    done += part
                    sizes += apart
                    ids.append(new)
                else:
                    other += part
        for start in range(0, len(other), 4096):
            part = other[start : start + 4096]
            cuts = [fresh[at] for at in part]
            whole = [" " + cut if self.joined and cut[:1] != "\n" else cut for cut in cuts]
            new = [out.ids for out in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
            done += part
            sizes += map(len, new)
            ids.append(np.fromiter(chain.from_iterable(new), "<u4"))
        more = len(known) - len(self.starts)
        self.starts, self.sizes = np.pad(self.starts, (0, more)), np.pad(self.sizes, (0, more))
        self._fill(np.array(done, np.int64) + base, sizes, ids)
        self.starts[runs] = -1
        # Marks after a word are a stretch of their own.
        for new in set(marks).difference(self.marks):
            self.marks[new] = self._ids(new)
        ends = [self.marks[m] for m in marks]
        stems = np.array(stems, np.int64)
        parts = np.split(self.flat[_spans(self.starts[stems], self.sizes[stems])], np.cumsum(self.sizes[stems])[:-1])
        sizes = self.sizes[stems] + np.fromiter(map(len, ends), np.int64)
        self._fill(np.array(marked, np.int64) + base, sizes, list(chain.from_iterable(zip(parts, ends, strict=False))))

    def _fill(self, numbers: np.ndarray, sizes: list | np.ndarray, ids: list[np.ndarray]) -> None:
        """Put down the ids of cuts, which lie one after the other."""
        if len(numbers):
            self.sizes[numbers] = sizes
            self.starts[numbers] = len(self.flat) + np.cumsum(sizes) - sizes
            self.flat = np.concatenate([self.flat, *ids])

    def _apart(self, ids: np.ndarray, words: bool) -> list[int]:
        """How many ids each cut has, of those encoded as one text; another number of cuts if some is not one piece."""
        at = np.nonzero(self.edges[ids] if words else ids == self.line_end)[0]
        if self.joined:  # a token that begins each cut
            starts, ends = at, np.append(at[1:], len(ids))
        else:  # a token that ends each cut
            starts, ends = np.append(0, at[:-1] + 1), at + 1
        if not len(at) or starts[0] or ends[-1] != len(ids):
            return []
        return (ends - starts).tolist()

    def encode(self, texts: list[str]) -> list[bytes]:
        cuts = pc.split_pattern(pa.array(map(self._spaced, texts), pa.large_string()), " ")
        counts = pc.list_value_length(cuts).to_numpy()
        numbers = self._numbers(cuts.flatten())
        out = self._joint(numbers, counts, int(self.joined))
        if self.joined:
            out = [ids + self.line if self._ends_line(text) else ids for ids, text in zip(out, texts, strict=True)]
            runs = np.unique(np.repeat(np.arange(len(texts)), counts)[self.starts[numbers] < 0]).tolist()
            split = [_WORD_STARTS.split(texts[i]) for i in runs]
            rest = self._numbers(pa.array([cut[1:] for _, *cuts in split for cut in cuts], pa.large_string()))
            coded = self._joint(rest, np.array([len(cuts) - 1 for cuts in split], np.int64))
            for i, (first, *_), ids in zip(runs, split, coded, strict=True):
                out[i] = self._ids(first).tobytes() + ids
        self._forget()
        pa.default_memory_pool().release_unused()
        return out

    def _forget(self) -> None:
        """Drop fresh cuts that are too long to come again and, beyond what may be remembered, the quarter that came last."""
        known, fresh = self.known, self.known.fresh
        base, stay = len(known) - len(fresh), [len(cut) <= LONGEST for cut in fresh]
        kept = None
        if not all(stay):
            for cut in fresh:
                del known[cut]
            known.update(zip(compress(fresh, stay), range(base, len(self.starts))))  # noqa: B905
            kept = np.append(np.arange(base), base + np.flatnonzero(stay))
        if len(known) > REMEMBERED:
            first = list(islice(known, REMEMBERED * 3 // 4))
            known.clear()
            known.update(zip(first, range(len(first)), strict=True))
            kept = (np.arange(len(self.starts)) if kept is None else kept)[: len(first)]
            self.marks.clear()
        if kept is not None:
            starts, self.sizes = self.starts[kept], self.sizes[kept]
            self.flat = self.flat[_spans(starts, self.sizes)]
            self.starts = np.where(starts < 0, -1, np.cumsum(self.sizes) - self.sizes)
        fresh.clear()
        self.learned = 0


def some_texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about BYTES of its column ``text``, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    slices = np.cumsum(sizes, dtype=np.int64) // BYTES
    bounds = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), batch.num_rows]
    for a, b in pairwise(bounds):
        yield batch.slice(a, b - a)


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, joined: bool) -> Encoder:
    """This process's encoder of a tokenizer file."""
    take_turn("encoding", _encoders.clear)
    if (path, joined) not in _encoders:
        _encoders[path, joined] = Encoder(path, joined)
    return _encoders[path, joined]


def is_joined(path: str) -> bool:
    """Whether a tokenizer file keeps white space: then words hold the space before them."""
    import json

    with open(path, encoding="utf-8") as file:
        kind = json.load(file).get("pre_tokenizer") or {}
    return kind.get("type") == "ByteLevel" and bool(kind.get("use_regex", True))
