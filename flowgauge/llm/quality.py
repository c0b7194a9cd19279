"""Text quality by a generalised additive model on shape statistics of whole texts."""

from collections import Counter
from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.additive_model import AdditiveModel, fit_additive
from flowgauge.llm.labelled import held_out, kept_by_score, labelled_sample, scored

FEATURES = (
    "log_words", "mean_word", "distinct_words", "top_word", "repeated_next", "distinct_trigrams", "upper", "digits",
    "symbols", "sentence_marks", "other_bytes", "bare_symbols", "symbol_ends", "capital_words", "log_lines",
    "repeated_lines", "line_words", "entropy",
)

_CLASS = np.zeros(256, np.int64)
for _start, _stop, _kind in ((65, 91, 1), (97, 123, 2), (48, 58, 3), (128, 256, 4), (9, 14, 6), (32, 33, 6)):
    _CLASS[_start:_stop] = _kind
for _mark in b".,;:?'\"-()":
    _CLASS[_mark] = 5
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
_ALNUM = frozenset(b for b in range(256) if _CLASS[b] in (1, 2, 3, 4))
_ENDS = frozenset(b".,;:?!'\"-)")


def text_features(text: bytes | None) -> list[float]:
    """One number per name in FEATURES, over the whole text; all zero for a null, empty or blank text."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, seen, minlength=7)
    ink = max(1.0, kinds.sum() - kinds[6])
    letters = max(1.0, float(seen[_LETTER].sum()))
    share = seen[seen > 0] / len(text)
    counts = Counter(words)
    # Word shapes depend on the distinct words alone.
    bare = symbol_ends = capitals = 0
    for word, times in counts.items():
        last = word[-1]
        if last not in _ALNUM:
            if not any(b in _ALNUM for b in word):
                bare += times
            elif last not in _ENDS or len(word) > 1 and word[-2] not in _ALNUM:
                symbol_ends += times
        capitals += times * (65 <= word[0] < 91)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2),
        kinds[1] / letters,
        kinds[3] / ink,
        kinds[0] / ink,
        kinds[5] / ink,
        kinds[4] / ink,
        bare / n,
        symbol_ends / n,
        capitals / n,
        float(np.log1p(len(lines))),
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        float(-(share * np.log2(share)).sum()),
    ]


def matrix(texts: list) -> np.ndarray:
    return np.array([text_features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("text").cast(pa.large_binary()).to_pylist())
        arrays = [batch.column("doc_id"), batch.column("y"), *(pa.array(x[:, j]) for j in range(x.shape[1]))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "y", *FEATURES])


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = 8_000) -> AdditiveModel:
    """Learn ``labels.quality`` from at most ``per_class`` documents of each class; held-out ids take no part.

    Features are computed on the executors; what reaches the driver is at most ``2 * per_class`` rows of numbers. The
    classes are weighed back to their shares among all labelled rows, so that a score is a probability. With fewer than 20
    such rows, or one class, all texts score the smoothed share of label 1 (``fit_additive``).
    """
    sample = labelled_sample(docs.select("doc_id", "text"), labels, "quality", per_class)
    schema = "doc_id long, y int, " + ", ".join(f"{name} double" for name in FEATURES)
    sample = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y")
    rows = sample.mapInArrow(_featured, schema).toPandas().sort_values(["doc_id", *FEATURES], kind="stable")
    y = rows["y"].to_numpy(np.float64)
    model = fit_additive(rows[list(FEATURES)].to_numpy(), y)
    if 0 < y.sum() < len(y):
        known = labels.where(~held_out() & F.col("quality").isin(0, 1))
        ones, all_ = known.agg(F.sum(F.col("quality").cast("long")), F.count("*")).first()
        model.bias += np.log(ones / (all_ - ones)) - np.log(y.sum() / (len(y) - y.sum()))
    return model


def quality_scorer(model: AdditiveModel) -> Callable[[list], np.ndarray]:
    """Scores from 0 to 1 of a list of texts; the model is a few kilobytes of tables."""
    return lambda texts: model.predict(matrix(texts))


def quality_scores(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id and score of every row: one pass over whole texts, no shuffle.

    Null, empty and blank texts get the score that the tables give to zeros. Repeated rows and rows with a null id come
    back once each; other columns are not read.
    """
    return scored(docs, quality_scorer(model), ["doc_id"])


def good_documents(docs: DataFrame, model: AdditiveModel, minimum: float = 0.3) -> DataFrame:
    """The rows of a score of ``minimum`` or more, with all of their columns."""
    return kept_by_score(docs, quality_scorer(model), lambda scores: scores >= minimum)
