"""Vector groups against all pairs."""

import itertools

import numpy as np
import pytest

from flowgauge.llm import hyperplane_dedup
from flowgauge.llm.hyperplane_dedup import near_duplicate_vectors, tables_and_bits
from llm_fixtures import reach

NAN, INF = float("nan"), float("inf")


def vectors(kind):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(100 + i, base[i % 40] + 0.12 * rng.standard_normal(16)) for i in range(80)]
    rows += [(300 + i, base[3]) for i in range(50)] + [(400 + i, 2.5 * base[5]) for i in range(5)]
    rows += [(500, base[7]), (500, base[7]), (500, base[8]), (0, base[9]), (0, base[10] * 3), (None, base[3]), (None, None)]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [NAN] + [1.0] * 15), (604, [INF] + [1.0] * 15)]
    rows += [(605, [None] + [1.0] * 15), (606, [1.0, 2.0]), (607, [1.0, 2.1]), (608, [-0.0, 3.0]), (609, [0.0, 3.0])]
    cast = (lambda x: float(np.float32(x))) if kind == "float" else float
    return [(i, None if v is None else [None if x is None else cast(x) for x in v], 7, 7, "x") for i, v in rows]


def plain(rows, cosine):
    def usable(i, v):
        return i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    use = [(k, i, np.array(v)) for k, (i, v, *_) in enumerate(rows) if usable(i, v)]
    pairs = [
        (k, h, i, j)
        for (k, i, a), (h, j, b) in itertools.combinations(use, 2)
        if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine - 1e-12
    ]
    roots = reach({r[0] for r in rows if r[0] is not None}, [(i, j) for _, _, i, j in pairs])
    counts = np.bincount([p for k, h, _, _ in pairs for p in (k, h)], minlength=len(rows))
    return sorted(((r[0], int(counts[k]), roots.get(r[0]), r[0] == roots.get(r[0])) for k, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("chunk", [hyperplane_dedup.CHUNK, 7])
def test_equals_all_pairs(spark, kind, chunk, monkeypatch):
    monkeypatch.setattr(hyperplane_dedup, "CHUNK", chunk)
    rows = vectors(kind)
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, rep int, copies int, label string").repartition(3)
    ours = sorted([tuple(r) for r in near_duplicate_vectors(df, 0.95).collect()], key=str)
    assert ours == plain(rows, 0.95)
    assert sum(r[1] > 0 for r in ours) > 100


def test_no_rows(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).isEmpty()


def test_miss_chance_does_not_grow():
    for n in (10, 10**5, 10**9, 10**12):
        tables, bits = tables_and_bits(n, 0.9)
        one = (1 - np.arccos(0.9) / np.pi) ** bits
        assert (1 - one) ** tables <= 0.002 and n / 2**bits <= max(n / 256, 1100)
