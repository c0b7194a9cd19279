"""Row and column selection."""

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions.timefns import monday_weekday


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the columns that exist; absent names are no error."""
    return df.drop(*columns)


def valid_swipes(df: DataFrame, status: str = "status") -> DataFrame:
    """Entries and exits; any other status, null too, is left out."""
    return df.where(F.col(status).isin(0, 1))


def boardings(df: DataFrame, status: str = "status") -> DataFrame:
    return df.where(F.col(status) == 1)


def with_direction_flags(df: DataFrame, status: str = "status") -> DataFrame:
    """Add ``inNums`` and ``outNums`` as 0/1 per event."""
    return df.withColumns(
        {
            "inNums": (F.col(status) == 1).cast("bigint"),
            "outNums": (F.col(status) == 0).cast("bigint"),
        }
    )


def for_stations(df: DataFrame, ids: list[int] | DataFrame, station: str = "stationID") -> DataFrame:
    """Rows of the given stations. ``ids`` is a list, or a table with the station column for many ids.

    A list always reaches the scan as a pushed filter. A table always becomes a semi-join, whose
    strategy follows from the table's size.
    """
    if isinstance(ids, DataFrame):
        return df.join(ids.select(station).distinct(), station, "left_semi")
    return df.where(F.col(station).isin(*ids))


def split_day_type(df: DataFrame, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Weekday rows and weekend rows."""
    weekend = monday_weekday(date) >= 5
    return df.where(~weekend), df.where(weekend)


def day_slice(df: DataFrame, station: int, date: datetime.date, time: str = "startTime") -> DataFrame:
    """Rows of one station on one day, as a time range so that the scan can skip data."""
    first = datetime.datetime.combine(date, datetime.time())
    after = first + datetime.timedelta(days=1)
    return df.where(
        (F.col("stationID") == station)
        & (F.col(time) >= F.lit(first.isoformat(" ")).cast("timestamp_ntz"))
        & (F.col(time) < F.lit(after.isoformat(" ")).cast("timestamp_ntz"))
    )


def align_columns(df: DataFrame, columns: list[str], fill: int = 0) -> DataFrame:
    """Exactly these columns in this order; absent ones hold ``fill``."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in columns])


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def first_rows(df: DataFrame, order: list[str | Column], n: int = 5) -> DataFrame:
    """First rows in a stated order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, order: str, n: int, keys: list[str] | None = None) -> DataFrame:
    """Last ``n`` rows in order, per key if keys are given.

    Spark keeps at most ``n`` rows of a key per task before it shuffles, so a large key is cheap.
    """
    if not keys:
        return df.orderBy(F.col(order).desc()).limit(n)
    ranked = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= n).drop("_rank")


def last_row(df: DataFrame, order: str, keys: list[str] | None = None) -> DataFrame:
    """The last row in order, per key if keys are given, as a plain aggregation."""
    keys = keys or []
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_last"))
    return last.where(F.col("_last").isNotNull()).select(*keys, "_last.*")
