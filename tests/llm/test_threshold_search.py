"""Threshold search against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgauge.llm import threshold_search
from flowgauge.llm.threshold_search import SortedLists, exact_topk, threshold_topk, topk_with_work


def plain(ids, vectors, query_ids, queries, k):
    out = []
    for i, q in zip(query_ids, queries, strict=True):
        scored = sorted((-int(v @ q), int(j)) for j, v in zip(ids, vectors, strict=True) if j != i)[:k]
        out += [(int(i), j, -s) for s, j in scored]
    return sorted(out)


@pytest.mark.parametrize("spread", [1, 3, 30])
def test_block_equals_all_products(spread):
    """Few values make many ties; skewed weights let the search stop early."""
    rng = np.random.default_rng(spread)
    x = rng.integers(-spread, spread + 1, (3000, 8)).astype(float)
    q = np.vstack([x[:20], rng.integers(-spread, spread + 1, (20, 8)) * np.array([9, 0, 0, 0, 1, 0, 0, 0]), np.zeros((1, 8))])
    ids, query_ids = rng.permutation(3000), np.arange(41)
    found, work = threshold_topk(ids, x, query_ids, q, 20)
    assert sorted(found) == plain(ids, x, query_ids, q, 20) and (work <= 3000).all()
    # With the k-th score of elsewhere, only what reaches it.
    floors = rng.integers(-spread, 20 * spread * spread, len(q)).astype(float)
    found, _ = threshold_topk(ids, x, query_ids, q, 20, floors)
    of = dict(zip(query_ids.tolist(), floors, strict=True))
    assert sorted(found) == [f for f in plain(ids, x, query_ids, q, 20) if f[2] >= of[f[0]]]


def test_search_stops_early():
    """A query on one dimension is answered from the end of one list; one of the common kind reads a part of each."""
    x = np.zeros((5000, 4))
    x[:, 0] = np.arange(5000)
    x[:, 1:] = np.random.default_rng(1).integers(-3, 4, (5000, 3))
    q = np.array([[5.0, 1.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0], [-300.0, 0.0, 1.0, 0.0]])
    found, work = threshold_topk(np.arange(5000), x, np.array([-1, -2, -3]), q, 5)
    assert sorted(found) == plain(np.arange(5000), x, [-1, -2, -3], q, 5) and work.max() < 700
    x = np.random.default_rng(3).normal(0, 1000, (20_000, 3)).round()
    found, work = threshold_topk(np.arange(20_000), x, np.arange(50), x[:50], 10)
    assert sorted(found) == plain(np.arange(20_000), x, range(50), x[:50], 10) and work.mean() < 0.1 * len(x)


@pytest.mark.parametrize("seed", range(6))
def test_unseen_vectors_score_less(seed):
    """Whatever the floor, the stops of all lists leave no vector unseen that reaches it, or are their ends."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-20, 21, (300, 5)).astype(float) * np.array([9, 1, 1, 0, 3])
    lists = SortedLists(np.arange(300), x)
    for w in rng.integers(-3, 4, (20, 5)).astype(float):
        values = lists.values(w)
        for floor in np.quantile(x @ w, [0.0, 0.3, 0.9, 1.0]).tolist() + [1e6]:
            stops = lists.stops_below(w, values, floor)
            seen = np.zeros(300, bool)
            for i, depth in enumerate(lists.depths[stops]):
                if w[i] and depth:
                    seen[lists.order[i, 300 - depth :] if w[i] > 0 else lists.order[i, :depth]] = True
            assert (x[~seen] @ w < floor).all() or (stops == len(lists.depths) - 1)[w != 0].all()


def test_blocks_are_skipped(spark, monkeypatch):
    """Vectors of unlike length: after the block with the longest ones, few others can hold anything better."""
    monkeypatch.setattr(threshold_search, "BLOCK", 100)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 8)) * np.exp(rng.normal(0, 1.5, (4000, 1)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = topk_with_work(df, F.col("vec_id") % 20 == 0, 20)
    whole = np.floor(64 * x)
    want = plain(np.arange(4000), whole, range(0, 4000, 20), whole[::20], 20)
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in got.rows.collect()) == want
    work = got.work.agg(F.sum("blocks"), F.sum("scored"), F.count("*")).first()
    assert work[2] == 200 and work[0] < 0.5 * 200 * 40 and work[1] < 0.25 * 200 * 4000


def test_large_components(spark):
    """Beyond what doubles hold exactly, whole numbers are used; beyond those, an error."""
    rng = np.random.default_rng(8)
    x = rng.integers(-(2**28), 2**28, (200, 4)) * 3 + 1
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["vec_id"], r["score"]) for r in exact_topk(df, F.col("vec_id") % 20 == 0, 7, scale=1).collect())
    assert got == plain(np.arange(200), x, range(0, 200, 20), x[::20], 7)
    with pytest.raises(ValueError, match="too large"):
        exact_topk(spark.createDataFrame([(0, [1e12]), (1, [1.0])], "vec_id long, embedding array<double>"), F.lit(True))


@pytest.mark.parametrize(("block", "side"), [(8192, 1024), (40, 6)])
def test_equals_all_products(spark, block, side, monkeypatch):
    monkeypatch.setattr(threshold_search, "BLOCK", block)
    monkeypatch.setattr(threshold_search, "QUERIES", side)
    rng = np.random.default_rng(7)
    rows = [(i, [float(c) for c in rng.integers(-4, 5, 6) / 50]) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(40)]
    rows += [(500, None), (501, []), (520, [float("nan")] * 6), (540, [None] * 6), (None, rows[1][1]), (560, [1.0, 2.0]), (561, [0.5, 0.5]), (562, [float("inf")] * 6)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<float>, rank int, score string").repartition(4)
    ours = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in exact_topk(df, F.col("vec_id") % 20 == 0, 20).collect())
    want = []
    for width in (6, 2):
        use = [(i, np.array([math.floor(64 * float(np.float32(c))) for c in v])) for i, v in rows if i is not None and v and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
        ask = [(i, v) for i, v in use if i % 20 == 0]
        found = plain([i for i, _ in use], [v for _, v in use], [i for i, _ in ask], [v for _, v in ask], 20)
        for i, _ in ask:
            mine = sorted((f for f in found if f[0] == i), key=lambda f: (-f[2], f[1]))
            want += [(i, n + 1, j, s) for n, (_, j, s) in enumerate(mine)]
    assert ours == sorted(want)


def test_no_rows(spark):
    assert exact_topk(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).isEmpty()
