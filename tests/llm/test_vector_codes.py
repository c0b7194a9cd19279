"""Product codes against plain loops, and the tree against all distances."""

import hashlib
import math

import numpy as np
import pytest

from flowgauge.llm.gnat import Gnat, squares
from flowgauge.llm.vector_codes import code_vectors


def plain(rows, parts, entries, rounds, scale):
    """Rows of (vec_id, vector, label) to the operator's rows, one number at a time."""
    kept = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    whole = [[math.floor(scale * c) for c in r[1]] for r in kept]
    w = len(whole[0]) // parts
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i]))[:entries]
    cut = [[tuple(x[p * w : (p + 1) * w]) for p in range(parts)] for x in whole]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]

    def assigned():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(x[p], c, strict=True)), e) for e, c in enumerate(books[p])) for p in range(parts)]
            for x in cut
        ]

    for _ in range(rounds):
        codes = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[i][p] for i in range(len(cut)) if codes[i][p][1] == e]
                if mine:
                    books[p][e] = [sum(m[j] for m in mine) // len(mine) for j in range(w)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    codes = assigned()
    errors = [sum(d for d, _ in c) for c in codes]
    by_label = {}
    for r, e in zip(kept, errors, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted(
        ((r[0], "".join(f"{e:02x}" for _, e in c), err, by_label[r[2]], digest) for r, c, err in zip(kept, codes, errors, strict=True)),
        key=str,
    )


def coded(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    return sorted([tuple(r) for r in code_vectors(df.repartition(3), **options).collect()], key=str)


@pytest.mark.parametrize("spread", [0.02, 1.0, 300.0])
def test_equals_plain(spark, spread):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * spread).tolist(), int(i % 3) if i % 7 else None) for i in range(120)]
    rows += [(200, None, 1), (201, [1.0] * 7 + [None], 1), (202, [float("nan")] * 8, None), (203, [float("inf")] + [0.0] * 7, 2), (204, [], 2)]
    rows += [rows[3], rows[3], (3, rows[9][1], 2), (None, rows[4][1], 1), (300, [0.0] * 8, 9)]
    assert coded(spark, rows, parts=4, entries=20) == plain(rows, 4, 20, 2, 256)


def test_fewer_rows_than_entries_and_none(spark):
    rows = [(5, [0.1, 0.2], 1), (2, [0.1, 0.2], None), (9, [-0.3, 0.0], 1)]
    assert coded(spark, rows, parts=2) == plain(rows, 2, 64, 2, 256)
    assert coded(spark, [(1, None, 1), (2, [], None)], parts=2) == coded(spark, [(1, None, 2)], parts=2) == []


def test_many_labels(spark):
    """Rare labels take the join, frequent ones the broadcast."""
    rows = [(i, [i % 5 / 10, i % 7 / 10], 0 if i % 2 else i) for i in range(3000)]
    assert coded(spark, rows, parts=1, entries=4, rounds=1) == plain(rows, 1, 4, 1, 256)


def test_refuses_what_it_cannot_code(spark):
    with pytest.raises(ValueError, match="equal parts"):
        coded(spark, [(1, [1.0, 2.0], 1), (2, [1.0], 1)], parts=1)
    with pytest.raises(ValueError, match="equal parts"):
        coded(spark, [(1, [1.0, 2.0, 3.0], 1)], parts=2)
    with pytest.raises(ValueError, match="too large"):
        coded(spark, [(1, [1e300], 1)], parts=1)


@pytest.mark.parametrize("entries, width, spread", [(64, 4, 3), (64, 4, 500), (200, 2, 1 << 25), (256, 1, 20), (64, 3, 0)])
def test_tree_equals_all_distances(entries, width, spread):
    rng = np.random.default_rng(entries + width)
    book = rng.integers(-spread, spread + 1, (entries, width))
    x = rng.integers(-2 * spread, 2 * spread + 1, (2000, width))
    index, square = Gnat(book).nearest(x)
    all_ = squares(x, book)
    assert (index == all_.argmin(axis=1)).all() and (square == all_.min(axis=1)).all()


def test_tree_leaves_subtrees_out():
    """On clustered entries most distances are not taken."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-1000, 1000, (8, 4))
    book = centres[np.arange(64) % 8] + rng.integers(-10, 10, (64, 4))
    x = book[rng.integers(0, 64, 5000)] + rng.integers(-10, 10, (5000, 4))
    tree = Gnat(book)
    index, _ = tree.nearest(x)
    assert (index == squares(x, book).argmin(axis=1)).all()
    assert tree.comparisons() < 0.3 * 64 * len(x)
