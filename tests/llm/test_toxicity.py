"""The kernel against its definition, the machine's parts, odd texts, and held-out accuracy."""

import itertools
import random

import numpy as np
import pytest

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from flowgauge.llm.queries import op8_string_kernel_toxicity
from flowgauge.llm.string_kernel import DECAY, SPAN, Landmarks, fit_svm, normal, pieces, table_values, triples, words_of
from flowgauge.llm.toxicity import ToxicityModel, civil_documents, fit_toxicity, toxicity_scorer, toxicity_scores

SF = "/root/testdata/sf0.1"


def plain_kernel(a, b):
    """Common subsequences of three characters, weighed by the stretches they cover; normalised."""

    def vector(word):
        word, out = f"^{word}$", {}
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i < SPAN:
                key = (word[i], word[j], word[k])
                out[key] = out.get(key, 0) + DECAY ** (k - i + 1)
        return out

    x, y = vector(a), vector(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y)) if x and y else 0.0


def test_kernel_is_that_of_the_definition():
    rng = random.Random(1)
    words = ["verte", "vörte", "vert$", "vertd", "日本語学", "本日語学", "идиот", "idiot", "idi*ot", "i-d-i-o-t", "idoit", "a", "", "né", "ünïcode", "aaaa"] + ["".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(20)]
    word, triple, weight = triples(words)
    dense = np.zeros((len(words), triple.max() + 1))
    dense[word, triple] = weight
    for i, j in itertools.combinations_with_replacement(range(len(words)), 2):
        assert dense[i] @ dense[j] == pytest.approx(plain_kernel(words[i], words[j]))
    assert plain_kernel("idiot", "idi*ot") > 3 * plain_kernel("idiot", "inert")


def test_landmark_features_are_kernels_among_landmarks():
    some = ["idiot", "trash", "moron", "garden", "table"]
    z = Landmarks(some).features(some)
    assert z @ z.T == pytest.approx(np.array([[plain_kernel(a, b) for a in some] for b in some]), abs=1e-5)
    marks = Landmarks(some)
    direction = np.arange(1.0, marks.whiten.shape[1] + 1)
    other = ["idioot", "trsh", "xyz", "", "gardening"]
    assert table_values(other, marks.table(direction)) == pytest.approx(marks.features(other) @ direction, abs=1e-4)


def test_machine_separates():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 5))
    y = np.where(x[:, 0] + 0.3 > 0, 1.0, -1.0)
    w, b = fit_svm(x, y, np.ones(400) / 400, 1e-4)
    assert np.mean(np.sign(x @ w + b) == y) > 0.97


def test_words():
    assert words_of("You I D I O T, i.d.i.o.t end") >= {"you", "idiot", "end"}
    assert normal("..idiot!!") == "idiot" and normal("***") == "" and normal("i-d") == "i-d"
    long = "x" * 30 + "idiot" + "y" * 40
    assert all(any(long[i : i + SPAN] in p for p in pieces(long)) for i in range(len(long) - SPAN + 1))


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op8_string_kernel_toxicity(spark, SF)
    assert rows.count() == 10_000
    held = rows.where("held_out").join(labels, "doc_id").collect()
    hits = [(r["toxic"], r["predicted"]) for r in held]
    toxic = [p for y, p in hits if y]
    assert len(toxic) > 50 and np.mean(toxic) > 0.8
    assert np.mean([p for y, p in hits if not y]) < 0.03
    assert all((r["predicted"] == 1) == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in held)


def planted(spark, n=400):
    rng = random.Random(5)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    insults = ["blorgwit", "snazzlump", "quigfiend"]
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 200))]
        if i % 5 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_gaps_and_inserted_characters(spark):
    docs, labels = planted(spark)
    model = fit_toxicity(docs, labels)
    score = toxicity_scorer(model)
    bad = [b"bada blorgwit fo", b"what a BLORGWIT!", b"blor-gwit nata", b"you snazz*lump", b"b l o r g w i t", b"q.u.i.g.f.i.e.n.d", b"xx " * 20_000 + b"quigfiend"]
    good = [b"bada fo nata", b"", None, b" \n", b"dido kuku memo" * 500, b"lamp grow fine"]
    assert (score(bad) >= 0.5).all() and (score(good) < 0.5).all()


def test_odd_documents(spark, odd_docs, no_docs):
    docs, labels = planted(spark, 100)
    model = fit_toxicity(docs, labels)
    scores = toxicity_scores(odd_docs, model)
    assert scores.columns == ["doc_id", "score"] and scores.count() == odd_docs.count()
    assert scores.where("score is null or score < 0 or score > 1").isEmpty()
    kept = civil_documents(odd_docs, model, 1.1)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count()
    assert toxicity_scores(no_docs, model).isEmpty()


def test_one_class_or_no_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, 0) for i in range(12)] + [(None, 1), (1, None), (2, 9)], "doc_id long, toxic int")
    for docs, known in ((odd_docs, labels), (odd_docs, labels.where("doc_id < 0")), (no_docs, labels)):
        model = fit_toxicity(docs, known)
        assert toxicity_scorer(model)([b"a b", None]).max() <= 0.5
    assert ToxicityModel().text_values([None, b""], {}).tolist() == [-1.0, -1.0]


def test_label_noise_and_long_texts_bar_no_insult(spark):
    """Clean labels on 2% of the texts, all with insults, and toxic texts of up to 20,000 words."""
    rng = random.Random(11)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(2, 4)))
    insults = ["blorgwit", "snazzlump", "quigfiend"]
    docs, labels = [], []
    for i in range(600):
        words = [word() for _ in range(20_000 if i % 60 == 0 else rng.randint(5, 200))]
        if i % 5 == 0 or i % 50 == 1:
            words.insert(rng.randrange(len(words)), insults[i // 5 % 3])
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    score = toxicity_scorer(fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
    bad = [b"bada blorgwit fo", b"what a SNAZZLUMP!", b"dido quig*fiend kuku"]
    good = [b"bada fo nata", b"dido kuku memo" * 500, b"tomi baku laso"]
    assert (score(bad) >= 0.5).all() and (score(good) < 0.5).all()


def test_no_suspect_is_reported(spark):
    docs = spark.createDataFrame([(i, "" if i % 2 else "some clean words") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    with pytest.warns(UserWarning, match="no word of toxic texts"):
        model = fit_toxicity(docs, labels)
    assert toxicity_scorer(model)([b"a b", None]).tolist() == pytest.approx([0.5, 0.5], abs=0.05)
