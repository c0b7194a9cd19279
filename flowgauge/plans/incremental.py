"""A roll-up that day files are added to, or replaced in, one by one."""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions.timefns import step_seconds
from flowgauge.operators.quality import missing_days
from flowgauge.operators.rows import valid_swipes, with_direction_flags
from flowgauge.operators.series import flow_by_slot, gap_fill, with_slot_end
from flowgauge.sources.ledger import file_ledger
from flowgauge.sources.readers import days_with_files, read_days

OBSERVED = "date date, stationID bigint, startTime timestamp_ntz, inNums bigint, outNums bigint"


def _folder(out: str, step: str) -> str:
    return f"{out.rstrip('/')}/observed_{step_seconds(step)}s"


def update_days(
    spark: SparkSession, raw: str, out: str, start: datetime.date, end: datetime.date, step: str = "10 minutes"
) -> DataFrame:
    """Roll the swipe files of a range of days up and put them in the place of what is kept of the same files' days.

    Returns the days of the range without a file that can be read; what is kept of those stays. Each file's day is a
    partition of its own, whatever days its swipes are of, and holds the sums of the slots that have any. Only the
    partitions of the days that were read are written, so a late day costs one day, and running a day twice changes
    nothing. A day whose files have no valid swipe any more is emptied.
    """
    ledger = file_ledger(spark, raw, start, end)
    days = days_with_files(ledger)
    swipes = with_direction_flags(valid_swipes(read_days(spark, raw, start, end, ledger=ledger)))
    sums = flow_by_slot(swipes, step, ["date", "stationID"])
    sums = sums.select("date", F.col("stationID").cast("bigint").alias("stationID"), "startTime", "inNums", "outNums")
    # A row without a station marks the day as read: its partition is written even if there is nothing else.
    marks = days.select("date", *[F.lit(None).cast(kind).alias(c) for c, kind in sums.dtypes[1:]])
    rows = sums.unionByName(marks).hint("rebalance", F.col("date")).sortWithinPartitions("date", "stationID", "startTime")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date")
    writer.parquet(_folder(out, step))
    return missing_days(days, start, end)


def kept_observed(spark: SparkSession, out: str, step: str = "10 minutes") -> DataFrame:
    """Sums per station and slot over all files kept; a slot that two days' files share has one row."""
    kept = spark.read.schema(OBSERVED).parquet(_folder(out, step)).where("stationID is not null")
    return kept.groupBy("stationID", "startTime").agg(F.sum("inNums").alias("inNums"), F.sum("outNums").alias("outNums"))


def kept_flow(spark: SparkSession, out: str, step: str = "10 minutes") -> DataFrame:
    """What ``station_flow`` gives of the swipes of all files kept: every station with every slot of all days.

    Stations and days are those of the sums, so a late file that brings a new station or a new first day needs no other
    day to be written again.
    """
    dense = gap_fill(kept_observed(spark, out, step), ["stationID"], "startTime", step, ["inNums", "outNums"])
    return with_slot_end(dense, step).select("stationID", "startTime", "endTime", "inNums", "outNums")
