"""What the ORC files hold against one call of the tokenizer per document."""

import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc
from tokenizers import Tokenizer

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from flowgauge.llm.token_orc import read_tokens, token_index, write_tokens

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def test_round_trip(spark, odd_docs, tmp_path):
    path = str(tmp_path / "tokens")
    write_tokens(odd_docs, path, BYTE)
    whole = Tokenizer.from_file(BYTE)
    want = sorted(
        ((r["doc_id"] if r["doc_id"] is not None else -1, [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 0])
         for r in odd_docs.select("doc_id", "text").collect()),
    )
    tokens = read_tokens(spark, path)
    have = sorted((r["doc_id"] if r["doc_id"] is not None else -1, list(r["ids"])) for r in tokens.collect())
    assert have == want
    # Ids ascend within and across files, and the rows of the index lie one after another.
    seen = []
    for file in sorted(glob.glob(f"{path}/part-*.orc")):
        seen += [-1 if i is None else i for i in pyarrow.orc.read_table(file).column("doc_id").to_pylist()]
    assert seen == sorted(seen) and len(seen) == len(want)
    index = sorted(token_index(tokens).collect(), key=lambda r: r["start"])
    at = 0
    for r in index:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [-1 if r["doc_id"] is None else r["doc_id"] for r in index] == seen
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in index) == sorted((len(ids), crc(ids)) for _, ids in want)


def test_few_documents_by_id(spark, odd_docs, tmp_path):
    path = str(tmp_path / "tokens")
    write_tokens(odd_docs, path, BYTE)
    some = read_tokens(spark, path, [3, 951])
    assert sorted(r["doc_id"] for r in some.collect()) == [3, 3, 951]
    plan = some._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan


def test_no_rows(spark, no_docs, tmp_path):
    path = str(tmp_path / "tokens")
    write_tokens(no_docs, path, BYTE)
    assert token_index(read_tokens(spark, path)).isEmpty()
