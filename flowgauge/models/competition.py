"""Fitting the candidates, scoring them and keeping the winners."""

import functools
from collections.abc import Callable, Hashable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from flowgauge.models.estimators import DAILY_CANDIDATES, SLOT_CANDIDATES, Candidate, linear
from flowgauge.models.normal_equations import linear_folds
from flowgauge.operators.features import DAILY_FEATURES, daily_features, slot_feature_columns, slot_features
from flowgauge.operators.rows import for_stations
from flowgauge.operators.sampling import contiguous_folds, with_test_flag, with_time_test_flag
from flowgauge.operators.stats import best_model, fold_summary, regression_metrics

Result = TypeVar("Result")

TARGETS = ["inNums", "outNums"]
DAY_TYPES = {"weekday": 0, "weekend": 1}
LEADERBOARD = "day_type string, target string, model string, place int, n bigint, mse double, rmse double, r2 double"


@dataclass
class Fitted:
    """Winning models by key, the scores of all candidates, and the winners as a table."""

    models: dict[Hashable, PipelineModel]
    leaderboard: DataFrame
    winners: DataFrame
    features: list[str]


def run_all(spark: SparkSession, work: dict[Hashable, Callable[[], Result]], parallelism: int = 8) -> dict[Hashable, Result]:
    """Run pieces of driver work that start Spark jobs, several side by side."""

    @inheritable_thread_target(spark)
    def run(key: Hashable) -> tuple[Hashable, Result]:
        return key, work[key]()

    with ThreadPool(max(1, min(parallelism, len(work)))) as pool:
        return dict(pool.map(run, work, chunksize=1))


def fit_all(
    spark: SparkSession, work: dict[Hashable, tuple[Estimator, DataFrame]], parallelism: int = 8
) -> dict[Hashable, Transformer]:
    """Fit many models; each fit is a series of Spark jobs."""
    return run_all(spark, {k: functools.partial(e.fit, df) for k, (e, df) in work.items()}, parallelism)


def fit_and_score(estimator: Estimator, train: DataFrame, test: DataFrame, label: str) -> tuple[Transformer, Row]:
    """A fitted model and its one row of scores on the test rows."""
    model = estimator.fit(train)
    return model, regression_metrics(predict(test, model), label, "prediction").first()


def predict(df: DataFrame, model: Transformer, name: str = "prediction") -> DataFrame:
    """The table with the model's prediction and none of its inner columns."""
    return model.transform(df).select(*[F.col(c) for c in df.columns], F.col("prediction").alias(name))


def slot_training_table(flow: DataFrame, stations: list[int], onehot: list[str] | None = None) -> DataFrame:
    """Flow of the target stations with their features."""
    return slot_features(for_stations(flow, stations), stations, onehot=onehot)


def _training_rows(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """The rows in a stated number of partitions, dealt by key and sorted.

    A forest draws its samples per partition. With partitions that depend on the keys alone, a
    seeded fit is the same on any number of cores.
    """
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def fit_slot_models(
    flow: DataFrame,
    stations: list[int],
    candidates: dict[str, Candidate] | None = None,
    test_share: float = 0.2,
    seed: int = 42,
    split: str = "random",
    onehot: list[str] | None = None,
    training_partitions: int = 4,
) -> Fitted:
    """Weekday and weekend models of entries and of exits; least squared error on held-out rows wins.

    ``split="random"`` holds out ``test_share`` of each day type's rows by a digest of their
    keys, ``split="time"`` those from the first slot on that leaves at most that share after
    it. ``onehot`` names further features that get one 0/1 column per value.

    The training table is kept while the models are fitted, in ``training_partitions``
    partitions: raise it for long histories of many stations, but keep it the same for results
    that shall agree. What comes back to the driver are the scores, one row per candidate.
    """
    if split not in ("random", "time"):
        raise ValueError("split must be 'random' or 'time'")
    candidates = candidates or SLOT_CANDIDATES
    spark = flow.sparkSession
    features = slot_feature_columns(stations, onehot)
    table = slot_training_table(flow, stations, onehot).persist(StorageLevel.MEMORY_AND_DISK)
    present = {r["isWeekend"] for r in table.select("isWeekend").distinct().collect()}
    day_types = {name: flag for name, flag in DAY_TYPES.items() if flag in present}
    keys = ["stationID", "startTime"]
    rows = {}
    for name, flag in day_types.items():
        own = table.where(F.col("isWeekend") == flag)
        if split == "time":
            flagged = with_time_test_flag(own, "startTime", test_share)
        else:
            flagged = with_test_flag(own, keys, test_share, seed)
        rows[name] = _training_rows(flagged, keys, training_partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        work = {
            (day_type, target, model): functools.partial(
                fit_and_score,
                build(features, target),
                rows[day_type].where(~F.col("is_test")),
                rows[day_type].where("is_test"),
                target,
            )
            for day_type in day_types
            for target in TARGETS
            for model, build in candidates.items()
        }
        done = run_all(spark, work)
    finally:
        for frame in rows.values():
            frame.unpersist()
        table.unpersist()
    place = {model: i for i, model in enumerate(candidates)}
    scores = [
        (*key, place[key[2]], row["n"], row["mse"], row["rmse"], row["r2"]) for key, (_, row) in done.items()
    ]
    leaderboard = spark.createDataFrame(scores, LEADERBOARD)
    winners = best_model(leaderboard, "mse", ["day_type", "target"], "place")
    models = {(r["day_type"], r["target"]): done[(r["day_type"], r["target"], r["model"])][0] for r in winners.collect()}
    return Fitted(models, leaderboard, winners, features)


def cross_validate(
    table: DataFrame,
    features: list[str],
    candidates: dict[str, Candidate],
    folds: int = 5,
    order: str = "date",
) -> DataFrame:
    """R2 and RMSE of every candidate on every contiguous fold, for entries and exits.

    A fold is scored once for both measures, and scaling is learned inside the fold's training
    rows. Least squares lines of all folds come from one aggregation (``linear_folds``).
    Columns: ``target``, ``model``, ``place``, ``fold``, ``n``, ``mse``, ``rmse``, ``r2``.
    """
    place = {model: i for i, model in enumerate(candidates)}
    schema = "target string, model string, place int, fold int, n bigint, mse double, rmse double, r2 double"
    lines = [model for model, build in candidates.items() if build is linear]
    scores = [
        (target, model, place[model], *rest)
        for model in lines
        for target, *rest in linear_folds(table, features, TARGETS, folds, order)[1]
    ]
    fitted = {model: build for model, build in candidates.items() if model not in lines}
    if not fitted:
        return table.sparkSession.createDataFrame(scores, schema)
    # One row per day: a single sorted partition, so that a seeded fit is repeatable.
    numbered = contiguous_folds(table, order, folds).coalesce(1).sortWithinPartitions(order)
    numbered = numbered.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        used = [r["fold"] for r in numbered.select("fold").distinct().collect()]
        work = {
            (target, model, fold): functools.partial(
                fit_and_score,
                build(features, target),
                numbered.where(F.col("fold") != fold),
                numbered.where(F.col("fold") == fold),
                target,
            )
            for target in TARGETS
            for model, build in fitted.items()
            for fold in used
        }
        done = run_all(table.sparkSession, work)
    finally:
        numbered.unpersist()
    scores += [
        (target, model, place[model], fold, row["n"], row["mse"], row["rmse"], row["r2"])
        for (target, model, fold), (_, row) in done.items()
    ]
    return table.sparkSession.createDataFrame(scores, schema)


def fit_daily_models(
    daily: DataFrame, candidates: dict[str, Candidate] | None = None, folds: int = 5
) -> Fitted:
    """Models of daily entries and exits; the best mean R2 over the folds wins and is fitted on all days.

    The table has one row per day, so every candidate is fitted on every fold.
    """
    candidates = candidates or DAILY_CANDIDATES
    table = daily_features(daily).coalesce(1).sortWithinPartitions("date").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scores = cross_validate(table, DAILY_FEATURES, candidates, folds)
        leaderboard = fold_summary(scores, ["target", "model", "place"])
        winners = best_model(leaderboard, "r2_mean", ["target"], "place", highest=True)
        chosen = {r["target"]: r["model"] for r in winners.collect()}
        work = {target: (candidates[name](DAILY_FEATURES, target), table) for target, name in chosen.items()}
        models = fit_all(table.sparkSession, work)
    finally:
        table.unpersist()
    return Fitted(models, leaderboard, winners, DAILY_FEATURES)


def save_models(fitted: Fitted, path: str) -> None:
    """Save every winner below ``path``, in a folder named by its key."""
    for key, model in fitted.models.items():
        name = "-".join(key) if isinstance(key, tuple) else str(key)
        model.write().overwrite().save(f"{path}/{name}")


def load_slot_models(path: str, day_types: list[str] | None = None) -> dict[Hashable, PipelineModel]:
    return {
        (day_type, target): PipelineModel.load(f"{path}/{day_type}-{target}")
        for day_type in day_types or DAY_TYPES
        for target in TARGETS
    }


def load_daily_models(path: str) -> dict[Hashable, PipelineModel]:
    return {target: PipelineModel.load(f"{path}/{target}") for target in TARGETS}
