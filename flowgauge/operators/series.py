"""Slots, gap filling, grids and row windows on time series."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions.timefns import bucket, day_start, step_interval, step_seconds
from flowgauge.operators.order import over_long_order


def flow_by_slot(
    df: DataFrame,
    step: str = "10 minutes",
    keys: list[str] | None = None,
    time: str = "time",
    slot: str = "startTime",
) -> DataFrame:
    """Sums of ``inNums`` and ``outNums`` per key and slot; only slots that have events.

    Rows with a null key or time are left out. The partial sums are made before the shuffle,
    so a key with a third of all rows sends no more than one row per slot and task.
    """
    keys = ["stationID"] if keys is None else keys
    known = df.dropna("any", subset=[*keys, time])
    return (
        known.select(*keys, bucket(time, step).alias(slot), "inNums", "outNums")
        .groupBy(*keys, slot)
        .agg(F.sum("inNums").alias("inNums"), F.sum("outNums").alias("outNums"))
    )


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distribute by key over the session's full number of shuffle partitions.

    For rows that are about to become many. Adaptive execution would merge partitions by their
    size before that, and make a large dense table from a small sparse one in a single task; a
    stated number of partitions is left alone.
    """
    if not keys:
        return df
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def time_span(df: DataFrame, time: str, values: list[str]) -> Column:
    """First and last time of the whole table as one struct ``lo``, ``hi``: a one-row subquery.

    The condition is always true. It reads the value columns so that the subquery needs the
    same columns as the rows it is used for; Spark then runs the aggregation below both of
    them once and reuses its shuffle, and a raw table is scanned once instead of twice.
    """
    live = F.when(F.hash(*values) >= F.lit(-(2**31)), F.col(time))
    return df.agg(F.struct(F.min(live).alias("lo"), F.max(live).alias("hi")).alias("span")).scalar()


def gap_fill(
    df: DataFrame,
    keys: list[str],
    time: str,
    step: str,
    values: list[str],
    bounds: str = "global",
    fill: int = 0,
    only: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Give every key a row for every slot, with ``fill`` where there was none.

    ``bounds="global"``: all keys run from midnight of the table's first day to the last slot
    of its last day. ``bounds="group"``: each key runs from its own first to its own last slot.
    ``only`` picks the rows to fill, after the bounds are taken from all.

    ``df`` has one row per key and slot. Each row knows the next one of its key and emits the
    slots up to it, so only the slots that have data are shuffled and sorted; the dense table
    is made after the last shuffle, and needs neither a join nor a cross product.
    """
    if bounds not in ("global", "group"):
        raise ValueError("bounds must be 'global' or 'group'")
    one = step_interval(step)
    series = Window.partitionBy(*keys).orderBy(time)
    rows = spread(only(df) if only else df, keys).select(
        *keys,
        F.col(time).alias("_seen"),
        *values,
        F.lag(time).over(series).alias("_before"),
        F.lead(time).over(series).alias("_after"),
    )
    if bounds == "global":
        rows = rows.withColumn("_span", time_span(df, time, values))
        first = F.when(F.col("_before").isNull(), day_start("_span.lo")).otherwise(F.col("_seen"))
        after = F.coalesce("_after", day_start("_span.hi") + F.expr("INTERVAL '1' DAY"))
        rows = rows.select(*keys, "_seen", *values, first.alias("_first"), (after - one).alias("_last"))
    else:
        last = F.coalesce(F.col("_after") - one, F.col("_seen"))
        rows = rows.select(*keys, "_seen", *values, F.col("_seen").alias("_first"), last.alias("_last"))
    dense = rows.select(*keys, "_seen", *values, F.explode(F.sequence("_first", "_last", one)).alias(time))
    seen = F.col(time) == F.col("_seen")
    kinds = dict(df.dtypes)
    return dense.select(
        *keys,
        time,
        *[F.when(seen, F.col(v)).otherwise(F.lit(fill).cast(kinds[v])).alias(v) for v in values],
    )


def calendar_spine(df: DataFrame, keys: list[str], time: str, step: str) -> DataFrame:
    """Every key with every slot from midnight of the first day to the end of the last day."""
    counted = df.dropna("any", subset=[*keys, time]).groupBy(*keys).agg(
        F.min(time).alias("_lo"), F.max(time).alias("_hi")
    )
    span = counted.agg(F.struct(F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).alias("span")).scalar()
    first = day_start("_span.lo")
    last = day_start("_span.hi") + F.expr("INTERVAL '1' DAY") - step_interval(step)
    return spread(counted.withColumn("_span", span), keys).select(
        *keys, F.explode(F.sequence(first, last, step_interval(step))).alias(time)
    )


def with_slot_end(df: DataFrame, step: str, start: str = "startTime", end: str = "endTime") -> DataFrame:
    return df.withColumn(end, F.col(start) + step_interval(step))


def rolling_mean(
    df: DataFrame, keys: list[str], order: str, column: str, n: int, name: str, include_current: bool = True
) -> DataFrame:
    """Mean of the last ``n`` rows of the key, fewer at its start.

    Without keys the table is one series of any length, in blocks (``over_long_order``).
    """
    frame = (-(n - 1), 0) if include_current else (-n, -1)
    if not keys:
        return over_long_order(df, [order], n, lambda w: {name: F.avg(column).over(w.rowsBetween(*frame))})
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(*frame)
    return df.withColumn(name, F.avg(column).over(window))


def lag_or_self(df: DataFrame, keys: list[str], order: str, column: str, name: str) -> DataFrame:
    """Value of the row before, by row and not by date; the first row has its own value."""
    if not keys:
        return over_long_order(df, [order], 1, lambda w: {name: F.coalesce(F.lag(column).over(w), F.col(column))})
    window = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(name, F.coalesce(F.lag(column).over(window), F.col(column)))


def future_dates(base: Column, days: int) -> Column:
    """Array of ``days`` dates from ``base`` on."""
    return F.sequence(base, F.date_add(base, days - 1))


def slot_grid(stations: DataFrame, base: Column, days: int, step: str = "10 minutes") -> DataFrame:
    """Every station with every slot of ``days`` days from the date ``base`` on."""
    slots = (86400 // step_seconds(step)) * days
    first = base.cast("timestamp_ntz")
    starts = F.sequence(first, first + step_interval(step) * F.lit(slots - 1), step_interval(step))
    grid = spread(stations, ["stationID"]).select("stationID", F.explode(starts).alias("startTime"))
    return with_slot_end(grid, step)


def linspace_grid(df: DataFrame, key: str, x: str, n: int = 300) -> DataFrame:
    """``n`` evenly spaced points from the first to the last ``x`` of each key.

    ``x`` is a number or a time; times come out to the microsecond.
    """
    ends = df.groupBy(key).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    points = ends.select(key, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("point"))
    position = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("point") / F.lit(n - 1)
    return points.select(key, "point", position.alias(x))
