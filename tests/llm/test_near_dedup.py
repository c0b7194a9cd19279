"""SuperMinHash groups against all pairs of full sets."""

import itertools
import random
import re

import numpy as np
import pytest
from conftest import rows_of

from flowgauge.llm import near_dedup
from flowgauge.llm.components import components
from flowgauge.llm.near_dedup import near_duplicates, spanning_links
from flowgauge.llm.super_minhash import EMPTY, ROUND, WordHashes, shingle_set, signatures
from llm_fixtures import no_docs, odd_docs, reach  # noqa: F401


def plain_set(text, width):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_groups(rows, width, percent):
    """(doc_id, n_shingles, component, kept) of (doc_id, text) rows, over all pairs."""
    sets = [(i, plain_set(t, width)) for i, t in rows]
    links = [
        (i, j)
        for (i, a), (j, b) in itertools.combinations([(i, s) for i, s in sets if i is not None and s], 2)
        if 100 * len(a & b) >= percent * len(a | b)
    ]
    roots = reach({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), roots.get(i), i == roots.get(i)) for i, s in sets), key=str)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
@pytest.mark.parametrize("cell", [near_dedup.CELL_ELEMENTS, 300])
def test_equals_all_pairs(odd_docs, width, percent, cell, monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL_ELEMENTS", cell)
    ours = rows_of(near_duplicates(odd_docs, width, percent))
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert ours == plain_groups(rows, width, percent)
    assert sum(not r[3] for r in ours) > 30


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 90, 95, 100])
def test_bands_follow_the_similarity(percent):
    """The miss at the threshold is within its bound, and one more value a band would go beyond it."""
    bands, rows = near_dedup.bands_for(percent)
    assert bands * rows <= near_dedup.VALUES
    missed = (1 - (percent / 100) ** rows) ** bands
    longer = (1 - (percent / 100) ** (rows + 1)) ** (near_dedup.VALUES // (rows + 1))
    assert missed <= near_dedup.MISS < longer or rows == near_dedup.VALUES
    assert {80: (42, 6), 85: (36, 7)}.get(percent, (bands, rows)) == (bands, rows)


def test_no_rows(no_docs):
    out = near_duplicates(no_docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.isEmpty()


def test_spanning_links_connect_what_pairs_connect():
    rng = random.Random(1)
    for percent in (50, 85, 100):
        for _ in range(25):
            base = [rng.sample(range(200), rng.randint(1, 40)) for _ in range(4)]
            sets = []
            for _ in range(50):
                s = set(rng.choice(base))
                for _ in range(rng.randint(0, 4)):
                    s ^= {rng.randrange(200)}
                sets.append(np.array(sorted(s or {0}), np.uint64))
            pairs = set()
            for i, j in itertools.combinations(range(50), 2):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    pairs.add((i, j))
            found = spanning_links(np.arange(50), sets, percent)
            assert {tuple(sorted(p)) for p in found} <= pairs
            assert reach(range(50), found) == reach(range(50), pairs)
            assert len(found) < 50


def test_signature_estimates_similarity():
    """Shares of equal places lie around the similarity, closer than independent minima would."""
    rng = random.Random(2)
    m, errors = 128, []
    for k in range(60):
        n = rng.choice([3, 20, 150, 1500])
        a = np.unique(np.random.default_rng(k).integers(0, 2**63, n, np.uint64))
        b = np.unique(np.concatenate([a[: n - n // 4], np.random.default_rng(999 + k).integers(0, 2**63, n // 5 + 1, np.uint64)]))
        x, y = signatures([a, b], m)
        both = len(np.intersect1d(a, b))
        errors.append((x == y).mean() - both / (len(a) + len(b) - both))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_signature_is_that_of_one_element_at_a_time():
    """Early stopping and batches change nothing: the values are the minima over all elements and rounds."""
    sets = [np.arange(5, dtype=np.uint64), np.arange(400, dtype=np.uint64), np.array([9], np.uint64), np.empty(0, np.uint64)]
    whole = signatures(sets, 32)
    for s, row in zip(sets[:3], whole, strict=False):
        one = np.min([signatures([s[i : i + 1]], 32)[0] for i in range(len(s))], axis=0)
        assert (one == row).all()
    assert (whole[3] == EMPTY).all()
    # One element offers every round once.
    assert sorted(int(v) for v in whole[2] >> ROUND) == list(range(32))


def test_words_are_ascii_runs():
    hashes = WordHashes()
    assert (shingle_set("A b c  D".encode(), 3, hashes) == shingle_set("a B c\nd".encode(), 3, hashes)).all()
    assert len(shingle_set(b"one two", 3, hashes)) == 1 and not len(shingle_set(b" \t\r\n", 3, hashes))


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(200, k) for k in range(201, 260)] + [(300, 300), (301, 302), (302, 301), (None, 5)]
    found = components(spark.createDataFrame(links, "x long, y long"), "x", "y")
    want = {n: 0 for n in range(41)} | {n: 200 for n in range(200, 260)} | {301: 301, 302: 301}
    assert {r["node"]: r["root"] for r in found.collect()} == want and found.count() == len(want)
