"""Targets against resharing round by round; copies against an exact running sum."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from flowgauge.llm.mixing import mixed_documents, mixing_plan, source_targets


def plain_targets(sizes, weights, share, most):
    """Deal by weight; what is above a limit is dealt again among the others, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    limit = {s: Fraction(most) * sizes[s] for s in names}
    full, total = set(), Fraction(share) * sum(sizes.values())
    while True:
        rest = total - sum(limit[s] for s in full)
        left = [s for s in names if s not in full]
        level = rest / sum(weight[s] for s in left) if left else 0
        above = {s for s in left if level * weight[s] >= limit[s]}
        if not above:
            return {s: limit[s] if s in full else level * weight[s] for s in names}
        full |= above


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 1000, "c": 50, "d": 7, None: 300}, {"a": 5}, {"b": 0, "c": 100}, {"z": 1, "é": 1, "Z": 1, "a": 1}, {"a": 0, "b": 0}],
)
@pytest.mark.parametrize("share", [1.5, 0.5, 2.0])
def test_targets(spark, sizes, share):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    ours = {r["source"]: r["target"] for r in source_targets(df, (3, 1, 2), share, 2.0).collect()}
    want = plain_targets(sizes, (3, 1, 2), share, 2)
    assert set(ours) == set(want)
    for s, target in want.items():
        assert ours[s] == pytest.approx(float(target), abs=1e-9)


def test_plan_is_systematic_sampling(odd_docs):
    plan = mixing_plan(odd_docs).collect()
    rows = [(r["doc_id"], r["source"], r["text"]) for r in odd_docs.collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    units = Counter(rows)
    assert Counter((r["doc_id"], r["source"], r["rows"], r["size"]) for r in plan) == Counter(
        (i, s, n, size(t)) for (i, s, t), n in units.items()
    )
    sizes = defaultdict(int)
    for (_, s, t), n in units.items():
        sizes[s] += n * size(t)
    targets = plain_targets(dict(sizes), (3, 1, 2), 1.5, 2)
    by_source = defaultdict(list)
    for r in plan:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(float(targets[r["source"]]))
        draw = hashlib.md5(("7" if r["doc_id"] is None else f"7:{r['doc_id']}").encode()).hexdigest()
        by_source[r["source"]].append(((-r["size"] * r["rows"], draw), r))
    for source, own in by_source.items():
        own.sort(key=lambda x: x[0])
        rate = own[0][1]["target"] / sizes[source]
        offset = Fraction(int(hashlib.md5(f"7:offset:{source or ''}".encode()).hexdigest()[:7], 16), 1 << 28)
        part = Fraction(int((rate - int(rate)) * (1 << 28)), 1 << 28) + int(rate)
        want = [int(part * (k + 1) + offset) - int(part * k + offset) for k in range(len(own))]
        assert [r["copies"] for _, r in own] == want and max(want) <= 2
        taken = sum(r["copies"] * r["rows"] * r["size"] for _, r in own)
        assert abs(taken - targets[source]) <= max(r["rows"] * r["size"] for _, r in own)


def test_rows_are_emitted_as_planned(odd_docs):
    plan = mixing_plan(odd_docs)
    mixed = mixed_documents(odd_docs, plan)
    assert mixed.columns == odd_docs.columns
    times = {(r["doc_id"], r["source"], r["text_hash"]): r["copies"] for r in plan.collect()}
    key = ["doc_id", "source", "xxhash64(text) as h"]
    have = Counter(tuple(r) for r in odd_docs.selectExpr(*key).collect())
    assert Counter(tuple(r) for r in mixed.selectExpr(*key).collect()) == Counter({k: n * times[k] for k, n in have.items() if times[k]})
    assert sorted(map(str, plan.collect())) == sorted(map(str, mixing_plan(odd_docs.repartition(2)).collect()))


def test_no_rows(no_docs):
    plan = mixing_plan(no_docs)
    assert plan.isEmpty() and mixed_documents(no_docs, plan).isEmpty()
