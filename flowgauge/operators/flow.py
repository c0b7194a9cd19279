"""Sums over flow tables."""

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_directions(ins: DataFrame, outs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Full outer join of entry counts and exit counts; a side without a row counts 0.

    Both sides have one row per key, so no key is larger than another.
    """
    keys = keys or ["stationID", "startTime"]
    zero = F.lit(0).cast("bigint")
    return ins.join(outs, keys, "full_outer").select(
        *keys,
        F.coalesce("inNums", zero).alias("inNums"),
        F.coalesce("outNums", zero).alias("outNums"),
    )


def daily_totals(flow: DataFrame, keys: list[str] | None = None, time: str = "startTime") -> DataFrame:
    """Entries and exits per day, and per key if keys are given."""
    keys = keys or []
    return flow.groupBy(*keys, F.to_date(time).alias("date")).agg(
        F.sum("inNums").alias("inNums"), F.sum("outNums").alias("outNums")
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a column some frame lacks is null there."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
