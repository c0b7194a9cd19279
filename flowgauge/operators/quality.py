"""Duplicates, nulls, missing names and missing days."""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.operators.series import spread


def dedup(df: DataFrame) -> DataFrame:
    """One row of each set of equal rows; nulls count as equal.

    Copies meet in the map-side aggregation, so one row with very many copies costs one
    shuffled row per task.
    """
    return df.dropDuplicates()


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column."""
    return df.dropna("any")


def quality_audit(df: DataFrame) -> DataFrame:
    """One row of counts about a raw table, from a single pass and a single wide shuffle.

    ``rows`` and ``duplicate_rows`` are about the table as given. ``null_cells``,
    ``incomplete_rows`` and ``null_<column>`` are about it after the duplicates are gone, as
    cleaning sees it. ``clean_rows`` is what cleaning leaves.
    """
    return audit_of_copies(with_copies(df))


def with_copies(df: DataFrame) -> DataFrame:
    """Distinct rows and ``_copies``, how often each is there."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))


def audit_of_copies(copies: DataFrame) -> DataFrame:
    """:func:`quality_audit` from the table of distinct rows."""
    columns = [c for c in copies.columns if c != "_copies"]
    nulls = {c: F.col(c).isNull().cast("bigint") for c in columns}
    null_cells = sum(nulls.values(), F.lit(0).cast("bigint"))

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0).cast("bigint"))

    return copies.agg(
        total(F.col("_copies")).alias("rows"),
        total(F.col("_copies") - 1).alias("duplicate_rows"),
        total(null_cells).alias("null_cells"),
        total((null_cells > 0).cast("bigint")).alias("incomplete_rows"),
        total((null_cells == 0).cast("bigint")).alias("clean_rows"),
        *[total(flag).alias(f"null_{c}") for c, flag in nulls.items()],
    )


def rollup_audit(swipes: DataFrame, station: str = "stationID", time: str = "time", status: str = "status") -> DataFrame:
    """One row of counts: the swipes, those that a roll-up counts, and why others are left out.

    A swipe with several faults counts for the first of: another status, no station, no time.
    """
    other = ~F.coalesce(F.col(status).isin(0, 1), F.lit(False))
    no_station, no_time = F.col(station).isNull(), F.col(time).isNull()
    return swipes.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~other & ~no_station & ~no_time).alias("counted"),
        F.count_if(other).alias("other_status"),
        F.count_if(~other & no_station).alias("no_station"),
        F.count_if(~other & ~no_station & no_time).alias("no_time"),
    )


def unmapped(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct ids that the name table does not know, a null id included.

    The ids are made distinct before the join, so its size is that of the id set.
    """
    ids = df.select(key).distinct()
    return ids.join(dim.select(key), key, "left_anti")


def missing_days(
    df: DataFrame,
    start: datetime.date | Column,
    end: datetime.date | Column,
    date: str = "date",
    keys: list[str] | None = None,
) -> DataFrame:
    """Days of ``start..end`` for which there is no row, per key if keys are given.

    A key without any row at all is not known here and so not reported.
    """
    keys = keys or []
    first = start if isinstance(start, Column) else F.lit(start)
    last = end if isinstance(end, Column) else F.lit(end)
    present = df.select(*keys, date).distinct()
    if keys:
        wanted = spread(df.select(*keys).distinct(), keys)
    else:
        wanted = df.sparkSession.range(1).select()
    wanted = wanted.select(*keys, F.explode(F.sequence(first, last)).alias(date))
    return wanted.join(present, [*keys, date], "left_anti")
