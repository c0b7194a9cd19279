"""Tokenizer alignment against a plain version that compares all tokens of a text."""

import hashlib
import tracemalloc
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from llm_fixtures import no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from flowgauge.llm import alignment
from flowgauge.llm.alignment import Aligner, align_tokenizers

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    """(rows in the operator's column order but doc_id, pair counts)."""
    tokenizer = Tokenizer.from_file(A_PATH)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)})
    names = {i: bytes(letters[c] for c in t) for t, i in tokenizer.get_vocab().items()}

    def piece(i):
        t = pieces.id_to_piece(i)
        return bytes([int(t[3:5], 16)]) if pieces.is_byte(i) else t.replace("▁", " ").encode()

    rows, counts = [], Counter()
    for text in texts:
        sides = []
        if text:
            for ids, of in ((tokenizer.encode(" " + text, add_special_tokens=False).ids, names.get), (pieces.encode(text), piece)):
                at, side = 0, []
                for i in ids:
                    side.append((i, at, at + len(of(i))))
                    at += len(of(i))
                sides.append((side, b"".join(of(i) for i in ids)))
        if not text or any(joined != (" " + text).encode() for _, joined in sides):
            rows.append((0, 0, 0, [], ""))
            continue
        a, b = sides[0][0], sides[1][0]
        both = {t[2] for t in a} & {t[2] for t in b}
        ends = sorted(both)
        groups = [[[], []] for _ in ends]
        place = {}
        for n, end in enumerate(ends):
            place.update(dict.fromkeys(range(ends[n - 1] if n else 0, end), n))
        for s, side in enumerate((a, b)):
            for i, start, _ in side:
                groups[place[start]][s].append(i)
        links = []
        for i, s, e in a:
            links += [(i, j) for j, t, f in b if s < f and t < e] if len(text) < 3000 else []
        if len(text) >= 3000:
            j = 0
            for i, s, e in a:
                while b[j][2] <= s:
                    j += 1
                k = j
                while k < len(b) and b[k][1] < e:
                    links.append((i, b[k][0]))
                    k += 1
        counts.update(links)
        digest = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        rows.append((len(a), len(b), len(ends), links, hashlib.sha256(digest.encode()).hexdigest()))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = [
        (na, nb, ng, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha)
        for na, nb, ng, links, sha in rows
    ]
    return out, counts, best


def expected(rows):
    out, counts, best = plain([t for _, t in rows])
    pairs = {(i, j, n, n == best[j]) for (i, j), n in counts.items()}
    return sorted(((d, *o) for (d, _), o in zip(rows, out, strict=True)), key=str), pairs


ODD = [
    "", " ", "  a  b ", "\n", "\r\n\t x", "x" * 3000, "<s> </s> <unk> <0x41> <|endoftext|>", "▁x", "a▁b", "é́ﬁ ａ １２",
    "日本語のテキスト 中文", "😀 👩‍👩‍👧 a", " 　 x", "a\x00b", "don't can't 1234567 ?!...", "naïve  Ünïcode", "�", "tab\there",
]


def check(spark, rows, docs=None):
    docs = docs if docs is not None else spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = align_tokenizers(docs, A_PATH, B_PATH)
    want, pairs = expected(rows)
    assert sorted((tuple(r) for r in got.documents.collect()), key=str) == want
    assert {tuple(r) for r in got.pairs.collect()} == pairs


def test_small_table_equals_plain(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    check(spark, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], docs)


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (None, "a b"), (None, None), (3, "repeated id"), (3, "repeated id")]
    check(spark, rows)


def test_odd_documents(spark, odd_docs):  # noqa: F811
    check(spark, [(r["doc_id"], r["text"]) for r in odd_docs.collect()], odd_docs)


def test_empty_table(spark, no_docs):  # noqa: F811
    got = align_tokenizers(no_docs, A_PATH, B_PATH)
    assert got.documents.count() == got.pairs.count() == 0
    assert got.documents.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("chars, windows", [(1, 400_000), (1 << 24, 2), (2_000, 50)])
def test_blocks_change_nothing(chars, windows, monkeypatch):
    """Small blocks and batches in one process: the same sums."""
    import pyarrow as pa

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 5

    import pyspark

    monkeypatch.setattr(pyspark, "TaskContext", Task)
    monkeypatch.setattr(alignment, "BLOCK_CHARS", chars)
    monkeypatch.setattr(alignment, "BLOCK_WINDOWS", windows)
    monkeypatch.setattr(alignment, "AT_ONCE", 100)
    texts = [f"one two {t} three" for t in ODD]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    first = pa.Table.from_batches(list(alignment._encoder(A_PATH, B_PATH)(iter([batch]))))
    pairs = first.filter(first.column("pair").is_valid()).select(["block", "pair", "n"]).to_pylist()
    total, best = Counter(), Counter()
    for p in pairs:
        total[p["pair"]] += p["n"]
    for p, n in total.items():
        best[p & 0xFFFFFFFF] = max(best[p & 0xFFFFFFFF], n)
    got = []
    for block in sorted(set(first.column("block").to_pylist())):
        mine = first.filter(pa.array([b == block for b in first.column("block").to_pylist()]))
        right = [{"pair": p["pair"], "count": total[p["pair"]], "best": total[p["pair"]] == best[p["pair"] & 0xFFFFFFFF]} for p in pairs if p["block"] == block]
        schema = pa.schema([("pair", pa.int64()), ("count", pa.int64()), ("best", pa.bool_())])
        got += alignment._summer(mine.filter(mine.column("pair").is_null()), pa.Table.from_pylist(right[::-1], schema)).to_pylist()
    assert sorted((tuple(g.values()) for g in got), key=str) == expected(list(enumerate(texts)))[0]


def test_calls_are_bounded(monkeypatch):
    """However many texts come together, the tokenizers get so many characters at once, or one longer text."""
    aligner, sizes = Aligner(A_PATH, B_PATH), []
    for kind in (alignment.ByteLevel, alignment.Pieces):
        call = kind.__call__
        monkeypatch.setattr(kind, "__call__", lambda self, texts, call=call: sizes.append(list(map(len, texts))) or call(self, texts))
    words = [f"w{i}x" for i in range(40_000)]
    texts = [" ".join(words), " " + "a  b " * 30_000, "", " c", *["  d e"] * 20_000]
    found = aligner.align(texts)
    assert max(sum(some) - some[-1] for some in sizes) <= alignment.IN_CALL < sum(map(len, texts))
    assert [len(f[0]) if f else 0 for f in found[:3]] == [40_000, len(Aligner(A_PATH, B_PATH).align(texts[1:2])[0][0]), 0]
    assert len({f[1] for f in found[4:]}) == 1


def test_summary_needs_little_beside_the_links():
    """A block's pairs and places are made without several copies of all of its links."""
    aligner = Aligner(A_PATH, B_PATH)
    for start in range(0, 100_000, 10_000):
        aligner.align([" ".join(f"w{i}x" for i in range(start, start + 10_000))])
    tracemalloc.start()
    pairs, counts, n_links, places = aligner.summary()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(places) == n_links.sum() == counts.sum() > 400_000 and (pairs[1:] > pairs[:-1]).all()
    assert peak < 16 * len(places)


def test_words_share_the_ids_of_their_windows():
    """A word's ids are kept once: what is remembered of it is the key of its window."""
    aligner = Aligner(A_PATH, B_PATH)
    first = aligner.align(["one two three", "  two  x", "three two one"])
    again = aligner.align(["three two one"])
    assert {id(k) for k in aligner.encode.known} <= {id(k) for k in aligner.numbers}
    assert (first[2][0] == first[0][0][::-1]).all() and (again[0][0] == first[2][0]).all() and again[0][1] == first[2][1]
    assert len(aligner.texts) == len(aligner.numbers) == sum(aligner.learned)
