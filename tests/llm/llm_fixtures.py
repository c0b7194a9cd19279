import random

import pytest

CLASHING = "score string, copies int, place int, rep long, a int, b int, y int, chunk int, size int, raw string, label int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, blanks, a very long text, ties, repeated rows and columns whose names clash."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    for i, t in enumerate(base):  # near copies: some words changed
        for j in range(3):
            w = t.split()
            for _ in range(1 + 2 * j):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((100 + 10 * i + j, " ".join(w).upper() if j == 1 else " ".join(w), "en", "s1"))
    rows += [(900 + k, base[0], "en", None) for k in range(20)]  # exact copies
    rows += [(950, None, None, "s0"), (951, "", "en", None), (952, " \t\n ", "en", "s2"), (953, "one two", "en", "s2"), (954, "ONE  two", "en", "s2")]
    rows += [(955, "word " * 60_000, "en", "s0"), (None, base[1], "en", "s1"), (None, None, None, None), (3, base[3], "en", "s0"), (4, base[7], "en", "s1")]
    rows += [(956, "naïve Ünïcode ́ ''s don't 12345 <|endoftext|>  \n\n  x \r\n\tÉ", "fr", "s2")]
    full = [(*r, len(r[1] or ""), "x", 7, 7, 7, 7, 7, 7, 7, 7, "x", 7) for r in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}").repartition(5)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("doc_id = -5")


def reach(nodes, links):
    """Smallest node that each reaches."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
