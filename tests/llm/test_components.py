"""Components against a plain union of sets, with hubs and long paths."""

import random

import pytest
from llm_fixtures import reach

from flowgauge.llm import components as module
from flowgauge.llm.components import components


def links_of(kind, rng):
    if kind == "paths":
        return [(i, i + 1) for i in range(200) if i % 50 != 49]
    if kind == "hub":  # one node with most of the links, whose number is in the middle
        return [(1000, i) for i in range(0, 3000, 3)] + [(rng.randrange(4000), rng.randrange(4000)) for _ in range(300)]
    return [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]


@pytest.mark.parametrize("kind", ["paths", "hub", "random"])
@pytest.mark.parametrize("few", [256, 3])
def test_equal_plain_components(spark, kind, few, monkeypatch):
    monkeypatch.setattr(module, "FEW", few)
    rng = random.Random(kind)
    links = links_of(kind, rng)
    links += [(b, a) for a, b in links[:20]] + links[:20] + [(7, 7)]
    rows = [*links, (None, 3), (3, None)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "x long, y long").repartition(4), "x", "y").collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == reach({n for link in real for n in link}, real)


def test_no_links(spark):
    assert components(spark.createDataFrame([(1, 1)], "x long, y long"), "x", "y").isEmpty()
