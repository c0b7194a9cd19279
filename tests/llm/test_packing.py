"""Packing against best-fit decreasing one piece at a time; tokens against one call of the tokenizer."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from flowgauge.llm import encoding
from flowgauge.llm.encoding import Encoder, is_joined
from flowgauge.llm.packing import OpenBins, best_fit_decreasing, pack_documents, packed_sequences

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD_TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b c", "a\nb", "a \nb", "a \n b", "a\n \n b ", "\n\n", "x\t\ty", " 'sa don't IT'S we'll",
    "é É ́a e ́ x ́", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|startoftext|>x", "naïve 日本語 テキスト", "\x1c a \x1cb", "a\u00a0 b \u00a0c",
    "a\u2028b \u3000 c", "12 345 6.7 --- !!! ?!", "🙂 🙂🙂", "İstanbul ΣΑΣ", "a" * 300 + " " + "b" * 70, "tab\tand  two  spaces \n\n end\r\n",
]


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_one_call(path):
    rng = random.Random(5)
    marks = [" ", "  ", "\n", " \n", "\t", "a", "Bc", "'s", "é", "́", "1", "!", "##", "_", "²", "½", "<", ">", "'", "’", "İ", "ª", "\u0958", "WORD", "<|endoftext|>", "\u00a0", "\x1c", "日", "the ", " and"]
    texts = ODD_TEXTS + ["".join(rng.choices(marks, k=rng.randint(1, 25))) for _ in range(1500)]
    assert is_joined(path) == (path == BYTE)
    encode = Encoder(path, is_joined(path)).encode
    whole = Tokenizer.from_file(path)
    for text, ids in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def plain_bins(lengths, capacity):
    """How full the bins of best-fit decreasing are; among equally full bins it may take any."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= length]
        if fits:
            max(fits, key=sum).append(length)
        else:
            bins.append([length])
    return Counter(sum(b) for b in bins)


@pytest.mark.parametrize("capacity", [1, 7, 10, 64, 100])
def test_runs_are_best_fit_decreasing(capacity):
    rng = random.Random(capacity)
    for _ in range(40):
        few = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        lengths = rng.choices(few, k=rng.randint(1, 120))
        runs = best_fit_decreasing(Counter(lengths), capacity)
        bins = defaultdict(dict)
        placed = Counter()
        for length, first, items, start, offset, each in runs.tolist():
            assert placed[length] == first
            placed[length] += items
            for k in range(items):
                bins[start + k // each][offset + k % each * length] = length
        assert placed == Counter(lengths)
        for content in bins.values():
            at = 0
            for offset in sorted(content):
                assert offset == at
                at += content[offset]
            assert at <= capacity
        assert Counter(sum(c.values()) for c in bins.values()) == plain_bins(lengths, capacity)


def test_tree_finds_the_tightest():
    tree, open_ = OpenBins(20), []
    rng = random.Random(1)
    for _ in range(500):
        if open_ and rng.random() < 0.5:
            tree.add(open_.pop(rng.randrange(len(open_))), -1)
        else:
            open_.append(rng.randint(1, 20))
            tree.add(open_[-1], 1)
        want = rng.randint(1, 20)
        assert tree.tightest(want) == min((x for x in open_ if x >= want), default=None)


def test_no_documents_no_runs():
    assert len(best_fit_decreasing({}, 10)) == 0


@pytest.mark.parametrize("capacity", [64, 2048])
def test_whole_documents(odd_docs, capacity):
    packed = pack_documents(odd_docs, WORD, capacity, keep_ids=True)
    rows = packed.collect()
    have = Counter()
    want = Counter()
    for r in odd_docs.select("doc_id", "text").collect():
        ids = [*ids_of(WORD, r["text"] or ""), 0]
        for k in range(0, len(ids), capacity):
            piece = ids[k : k + capacity]
            crc = zlib.crc32(np.array(piece, "<u4").tobytes())
            want[r["doc_id"], k // capacity, k, len(piece), crc, tuple(piece)] += 1
    by_bin = defaultdict(list)
    for r in rows:
        have[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])] += 1
        by_bin[r["sequence_id"]].append((r["offset"], r["length"]))
    assert have == want
    for content in by_bin.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by_bin) == sum(plain_bins([r["length"] for r in rows], capacity).values())
    sequences = packed_sequences(packed).collect()
    assert len(sequences) == len(by_bin) and all(len(s["ids"]) == sum(s["lengths"]) <= capacity for s in sequences)
    assert sum(len(s["ids"]) for s in sequences) == sum(k[3] * n for k, n in want.items())


def test_no_rows(no_docs):
    assert pack_documents(no_docs, WORD, 64).isEmpty()


def test_marks_are_cut_off():
    texts = ["Alpha. beta, Gamma.\nalpha, beta.", "x.", "a.. b.) 1. é. 's. <|endoftext|>. a<b. c. ", "end.\n", ".", "a.\n\nb.  c.\x00. d.", "a. b. c.\tD,"]
    for path in (WORD, BYTE):
        encoder = Encoder(path, is_joined(path))
        for _ in range(2):
            for text, ids in zip(texts, encoder.encode(texts), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == ids_of(path, text), repr(text)
        assert not {"alpha.", "beta,", "beta.", "alpha,", "Alpha."} & set(encoder.known)
        assert encoder.encode([]) == [] and encoder.encode([""]) == [b""]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_stay_right_while_cuts_are_forgotten(path, monkeypatch):
    monkeypatch.setattr(encoding, "REMEMBERED", 60)
    monkeypatch.setattr(encoding, "LONGEST", 6)
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("un", "The", "é", "12", "thinking", "日本") for b in ("", "er", "s.", "ing,", "'s", "!?", "\n", "  ", ".\n")]
    encoder = Encoder(path, is_joined(path))
    for _ in range(30):
        texts = [" ".join(rng.choices(words, k=rng.randint(0, 15))) for _ in range(8)]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(path, text), repr(text)
        assert len(encoder.known) == len(encoder.starts) <= 60 and max(map(len, encoder.known)) <= 6


def test_a_worker_remembers_half_a_million_cuts_at_most():
    letters = "bcdfghjklmnpqrst"
    words = ["".join(letters[n >> s & 15] for s in (16, 12, 8, 4, 0)) for n in range(600_000)]
    encoder = Encoder(WORD, False)
    for start in range(0, len(words), 100_000):
        encoder.encode([" ".join(words[start : start + 100_000])])
    assert 300_000 < len(encoder.known) <= 500_000


def test_slices_go_by_bytes(monkeypatch):
    monkeypatch.setattr(encoding, "BYTES", 10)
    texts = ["aaaa", None, "bbbb", "cccc", "d" * 35, "", "é" * 3]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    slices = [s.column("text").to_pylist() for s in encoding.some_texts(batch)]
    assert slices == [texts[:3], texts[3:4], texts[4:6], texts[6:]]
    assert sum(s.num_rows for s in encoding.some_texts(batch.slice(0, 0))) == 0
