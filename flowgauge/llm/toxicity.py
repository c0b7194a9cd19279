"""Toxic texts by a string-kernel support vector machine with Nyström landmarks.

A labelled text says that some word of it is an insult, or that none is. The machine scores words; a text's score is that of
its worst word, turned into a probability. Learning goes back and forth: choose each toxic text's witness, the word that
scores highest in it; fit the machine to the witnesses and to clean words, among them those it mistook last.
"""

import hashlib
import warnings
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.labelled import held_out, kept_by_score, labelled_sample, scored
from flowgauge.llm.string_kernel import TRIPLES, Landmarks, fit_svm, normal, pieces, table_values, triples, words_of
from flowgauge.llm.tables import stored
from flowgauge.llm.turns import released, take_turn

LANDMARKS = 256
#: Ridge penalty of the machine.
RIDGE = 3e-4
#: Clean words to learn from, drawn by hash.
CLEAN_WORDS = 6_000
#: Texts of either class that are added to what a word was counted in, so that odds of rare words stay near even.
SMOOTH = 0.5
#: Fits of the machine; words of clean texts that each adds to the next one's.
ROUNDS, MISTAKEN = 4, 1_000
#: Scores of words that a worker remembers.
REMEMBERED = 200_000
#: Texts whose words are held at once.
TEXTS_AT_ONCE = 256
_remembered: dict = {}


@dataclass
class ToxicityModel:
    """A number per triple, the intercept, and the slope and intercept from a worst word's value to log odds."""

    table: np.ndarray = field(default_factory=lambda: np.zeros(TRIPLES, np.float32))
    bias: float = -1.0
    slope: float = 1.0
    offset: float = -2.0

    def word_values(self, words: list[str]) -> np.ndarray:
        """The machine's value of each word: of its highest piece. A word without letters has the value of no triples."""
        parts = [pieces(normal(w)) for w in words]
        flat = table_values([p for ps in parts for p in ps], self.table) + self.bias
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        return np.maximum.reduceat(flat, starts) if len(words) else flat

    def text_values(self, texts: list, remembered: dict) -> np.ndarray:
        """The highest value of each text's words; that of an empty word for null, empty and blank texts."""
        parts = [self._some_values(texts[i : i + TEXTS_AT_ONCE], remembered) for i in range(0, len(texts), TEXTS_AT_ONCE)]
        return np.concatenate([np.empty(0), *parts])

    def _some_values(self, texts: list, remembered: dict) -> np.ndarray:
        bags = [words_of(t.decode("utf-8", "replace")) if t else () for t in texts]
        new = list({w for bag in bags for w in bag if w not in remembered})
        if len(remembered) + len(new) > REMEMBERED:
            remembered.clear()
            new = list({w for bag in bags for w in bag})
        for start in range(0, len(new), 4096):
            some = new[start : start + 4096]
            remembered.update(zip(some, self.word_values(some).tolist(), strict=True))
        return np.array([max(map(remembered.__getitem__, bag), default=self.bias) for bag in bags], np.float64)

    def probability(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * values + self.offset, -40, 40)))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        texts = batch.column("text").to_pylist()
        bags = [sorted({n for n in map(normal, words_of(t or "")) if len(n) > 2}) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(bags, pa.list_(pa.string()))], ["doc_id", "y", "words"])


def _platt(values: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps; smoothed targets, slope never below zero."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([values, np.ones(len(values))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (p - t) + 1e-3 * (w - np.array([1.0, 0.0]))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 4_000) -> ToxicityModel:
    """Learn ``labels.toxic`` from at most ``per_class`` documents of each class; held-out ids take no part.

    Words are counted over the whole sample, and no word is barred by its counts: a toxic text's first witness is its word
    of the highest smoothed log odds, later ones are the machine's choice among all of its words. Words of one or two letters
    are scored like any, but none is taken for an insult or a clean word to learn from. The choice is made on
    the executors; the driver gets one word a toxic text and round, and ``CLEAN_WORDS`` clean words. One text in four only
    sets the final curve. With labels of one class or none, all texts score the smoothed share of label 1; so they do,
    with a warning, if no toxic or no clean text of the sample has a word.
    """
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = labelled_sample(columns, labels, "toxic", per_class)
    bags = stored(sample.mapInArrow(_bags, "doc_id long, y int, words array<string>"), "bags")
    bags = bags.withColumn("curve", F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(4)) == 0)
    known = labels.where(~held_out() & F.col("toxic").isin(0, 1))
    total, toxic = known.agg(F.count("*"), F.sum(F.col("toxic").cast("long"))).first()
    toxic = toxic or 0
    if not 0 < toxic < total:
        share = (toxic + 0.5) / (total + 1)
        return ToxicityModel(slope=0.0, offset=float(np.log(share / (1 - share))))
    learned = bags.where(~F.col("curve"))
    used = learned.select("doc_id", "y", F.explode("words").alias("word"))
    counts = used.groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    texts = {r["y"]: r["n"] for r in learned.groupBy("y").agg(F.count("*").alias("n")).collect()}
    of_toxic = (F.col("t") + SMOOTH) / (texts.get(1, 0) + 2 * SMOOTH)
    of_clean = (F.col("c") + SMOOTH) / (texts.get(0, 0) + 2 * SMOOTH)
    counts = counts.withColumns({"odds": F.log(of_toxic / of_clean), "civil": F.sqrt("c") * of_clean / (of_toxic + of_clean)})
    counts = stored(counts, "words")
    civil = counts.where("c > 0")
    drawn = civil.orderBy(F.xxhash64("word"), "word").limit(CLEAN_WORDS)
    common = civil.orderBy(F.desc("civil"), "word").limit(CLEAN_WORDS // 4)
    clean = sorted(r["word"] for r in drawn.union(common).select("word").distinct().collect())
    toxic_words = used.where("y = 1").join(counts.where("t > 0").select("word", "odds"), "word")
    first = toxic_words.groupBy("doc_id").agg(F.max(F.struct("odds", "word")).alias("best")).select("best.*").toPandas()
    if first.empty or not clean:
        warnings.warn(f"no word of {'clean' if len(first) else 'toxic'} texts to learn from: all texts score alike", stacklevel=2)
        share = (toxic + 0.5) / (total + 1)
        return ToxicityModel(slope=0.0, offset=float(np.log(share / (1 - share))))
    model = _machine(_first_witnesses(first), clean, lambda m: _witnesses(learned, m), lambda m: _mistaken(civil, m))
    values = _values(bags.where("curve"), model)
    if values["y"].nunique() < 2:
        values = _values(bags, model)
    model.slope, model.offset = _platt(values["value"].to_numpy(), values["y"].to_numpy())
    # The sample's classes weigh as they do among all labelled rows.
    ones = max(1, int(values["y"].sum()))
    model.offset += np.log(toxic / (total - toxic)) - np.log(ones / max(1, len(values) - ones))
    return model


def _values(bags: DataFrame, model: ToxicityModel) -> pd.DataFrame:
    """(y, value, word) of the worst word of every bag; as many rows as the sample has texts."""

    def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for words in batch.column("words").to_pylist():
                values = model.word_values(words)
                best = int(values.argmax()) if len(words) else -1
                out.append((float(values[best]), words[best]) if len(words) else (model.bias, ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array([v for v, _ in out], pa.float64()), pa.array([w for _, w in out], pa.string())],
                ["y", "value", "word"],
            )

    return bags.select("y", "words").mapInArrow(worst, "y int, value double, word string").toPandas()


def _landmark_words(words: list[str], weight: np.ndarray, mistaken: list[str], clean: list[str]) -> list[str]:
    """Suspects one by one, each the heaviest of those unlike the earlier ones; mistaken words; clean words, evenly spaced."""
    order = np.argsort(-weight, kind="stable")
    some = [words[i] for i in order]
    word, triple, part = triples(some)
    heavy, far, chosen = np.sqrt(weight[order]), np.ones(len(some)), []
    for _ in range(min(LANDMARKS // 2, len(some))):
        i = int((heavy * far).argmax())
        chosen.append(some[i])
        vector = np.zeros(TRIPLES)
        vector[triple[word == i]] = part[word == i]
        far = np.minimum(far, np.clip(1 - np.bincount(word, part * vector[triple], minlength=len(some)), 0, 1))
        far[i] = 0
    chosen += mistaken[: LANDMARKS // 4]
    rest = LANDMARKS - len(chosen)
    return list(dict.fromkeys([*chosen, *clean[:: max(1, len(clean) // rest)][:rest]]))


def _first_witnesses(first: pd.DataFrame) -> dict[str, float]:
    """Weights of the words of the highest odds: those that many texts share and clean ones don't weigh most."""
    found = first.groupby("word")["odds"].agg(["size", "first"]).sort_index()
    weight = np.sqrt(found["size"]) * np.maximum(found["first"], 1e-3) ** 2
    return dict(zip(found.index, weight.tolist(), strict=True))


def _witnesses(bags: DataFrame, model: ToxicityModel) -> dict[str, float]:
    """The highest word of every toxic text, of all of its words, and the root of how many texts chose it."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered: dict[str, float] = {}
        for batch in batches:
            out = []
            for words in batch.column("words").to_pylist():
                if len(remembered) > REMEMBERED:
                    remembered.clear()
                new = [w for w in words if w not in remembered]
                for start in range(0, len(new), 4096):
                    some = new[start : start + 4096]
                    remembered.update(zip(some, model.word_values(some).tolist(), strict=True))
                out.append(max(words, key=remembered.__getitem__))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["word"])

    chosen = bags.where("y = 1 and size(words) > 0").select("words").mapInArrow(choose, "word string")
    times = Counter(r["word"] for r in chosen.collect())
    return {w: float(np.sqrt(times[w])) for w in sorted(times)}


def _mistaken(counts: DataFrame, model: ToxicityModel) -> dict[str, float]:
    """The words of clean texts that come nearest to insults, at most MISTAKEN of them, and their weights.

    A word weighs the root of how many clean texts use it, times the chance that a use of it is clean: a few clean texts
    with an insult don't speak against it.
    """

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.word_values(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("civil"), pa.array(values)], ["word", "civil", "value"])

    near = counts.select("word", "civil").mapInArrow(value, "word string, civil double, value double").where(F.col("value") > -0.5)
    return {r["word"]: r["civil"] for r in near.orderBy(F.desc("value"), "word").limit(MISTAKEN).collect()}


def _machine(
    witnesses: dict[str, float],
    clean: list[str],
    choose: Callable[[ToxicityModel], dict[str, float]],
    near: Callable[[ToxicityModel], dict[str, float]],
) -> ToxicityModel:
    """Fits in turn: to weighted witnesses, clean words and the words mistaken so far; each one chooses the next's."""
    often: dict[str, float] = {}
    for left in reversed(range(ROUNDS)):
        words, weight = list(witnesses), np.array(list(witnesses.values()))
        mistaken = [w for w, _ in sorted(often.items(), key=lambda x: (-x[1], x[0]))]
        landmarks = Landmarks(_landmark_words(words, weight, mistaken, clean))
        zp, zc = landmarks.features(words), landmarks.features(clean)
        z, y = [zp, zc], [np.ones(len(zp)), -np.ones(len(zc))]
        w = [weight / weight.sum(), np.full(len(zc), 0.5 / len(zc))]
        if mistaken:
            n = np.array([often[m] for m in mistaken])
            z, y, w = [*z, landmarks.features(mistaken)], [*y, -np.ones(len(n))], [*w, n / n.sum()]
        direction, bias = fit_svm(np.vstack(z), np.concatenate(y), np.concatenate(w), RIDGE)
        model = ToxicityModel(landmarks.table(direction).astype(np.float32), bias)
        if left:
            often.update(near(model))
            witnesses = choose(model)
    return model


def toxicity_scorer(model: ToxicityModel) -> Callable[[list], np.ndarray]:
    """Scores from 0 to 1 of a list of texts. A worker remembers the values of words while it scores with one model."""
    name = hashlib.blake2b(model.table.tobytes() + repr(model.bias).encode()).hexdigest()

    def score(texts: list) -> np.ndarray:
        take_turn("toxicity", _remembered.clear)
        if _remembered.get(0) != name:
            _remembered.clear()
            _remembered.update({0: name, 1: {}})
        return model.probability(model.text_values(texts, _remembered[1]))

    return score


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row: one pass over whole texts, no shuffle.

    Null, empty and blank texts score as a text of one empty word. Repeated rows and rows with a null id come back once
    each; other columns are not read.
    """
    return scored(docs, toxicity_scorer(model), ["doc_id"])


def civil_documents(docs: DataFrame, model: ToxicityModel, limit: float = 0.5) -> DataFrame:
    """The rows of a score under ``limit``, with all of their columns."""
    return kept_by_score(docs, toxicity_scorer(model), lambda scores: scores < limit)
