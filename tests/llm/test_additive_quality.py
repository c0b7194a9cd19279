"""The additive model's parts, odd texts, and held-out accuracy on the given labels."""

import numpy as np
import pytest

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from flowgauge.llm.additive_model import fit_additive
from flowgauge.llm.queries import op10_additive_quality
from flowgauge.llm.quality import FEATURES, fit_quality, good_documents, quality_scores, text_features

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op10_additive_quality(spark, SF)
    assert rows.count() == 10_000
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert len(held) > 500
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.98
    assert all((r["predicted"] == 1) == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in held)


def test_held_out_rows_are_one_in_five_by_crc(spark):
    import zlib

    rows = op10_additive_quality(spark, "/root/testdata/sf0.001").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_held_out_labels_are_not_learned(spark):
    """Scores stay the same when the held-out rows' labels are turned round."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality")
    one = {r["doc_id"]: r["score"] for r in quality_scores(docs, fit_quality(docs, labels)).collect()}
    two = {r["doc_id"]: r["score"] for r in quality_scores(docs, fit_quality(docs, turned)).collect()}
    assert one == two


def test_tables_hold_interactions():
    """A checkerboard has no single-feature signal; pairs find it. A step is found by a single feature."""
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 4))
    for y in (x[:, 0] * x[:, 1] > 0, x[:, 2] > 0.3):
        model = fit_additive(x[:3000], y[:3000])
        assert np.mean((model.predict(x[3000:]) >= 0.5) == y[3000:]) > 0.93
    sums = model.bias + sum(t[np.searchsorted(e, x[:, j], "right")] for j, (e, t) in enumerate(zip(model.edges, model.tables, strict=True)))
    for i, j, t in model.pairs:
        sums += t[np.searchsorted(model.coarse[i], x[:, i], "right"), np.searchsorted(model.coarse[j], x[:, j], "right")]
    assert np.allclose(sums, model.log_odds(x))


def test_one_class_or_no_rows():
    assert fit_additive(np.empty((0, 3)), np.empty(0)).predict(np.zeros((2, 3))) == pytest.approx(0.5)
    assert fit_additive(np.ones((50, 2)), np.ones(50)).predict(np.zeros((1, 2)))[0] > 0.98
    assert 0 < fit_additive(np.ones((50, 2)), np.arange(50) % 2).predict(np.ones((1, 2)))[0] < 1


def test_features():
    for text in (None, b"", b" \n\t"):
        assert text_features(text) == [0.0] * len(FEATURES)
    got = dict(zip(FEATURES, text_features(b"AB ab ab !! 12\nAB ab ab !! 12\n"), strict=True))
    assert got["log_words"] == pytest.approx(np.log(11)) and got["distinct_words"] == 0.4 and got["top_word"] == 0.4
    assert got["repeated_next"] == 0.2 and got["repeated_lines"] == 0.5 and got["bare_symbols"] == 0.2
    assert got["upper"] == pytest.approx(4 / 12) and got["digits"] == pytest.approx(4 / 20) and got["symbols"] == pytest.approx(4 / 20)
    assert all(np.isfinite(text_features("é́ 日本 ".encode() * 9)))


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(12)] + [(None, 1, "x"), (1, None, "x"), (2, 7, "x")], "doc_id long, quality int, text string")
    model = fit_quality(odd_docs, labels)
    scores = quality_scores(odd_docs, model)
    assert scores.columns == ["doc_id", "score"] and scores.count() == odd_docs.count()
    assert scores.where("score is null or score < 0 or score > 1").isEmpty()
    kept = good_documents(odd_docs, model, 0.0)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count()
    assert good_documents(odd_docs, model, 1.1).isEmpty()
    assert quality_scores(no_docs, fit_quality(no_docs, labels)).isEmpty()
    assert quality_scores(odd_docs, fit_quality(odd_docs, labels.where("doc_id < 0"))).count() == odd_docs.count()
