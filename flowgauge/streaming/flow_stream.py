"""The slot roll-up as a stream, for day files that keep arriving."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowgauge.functions.timefns import step_seconds
from flowgauge.operators.rows import valid_swipes, with_direction_flags
from flowgauge.operators.series import with_slot_end
from flowgauge.plans.rollup import observed_flow


def flow_stream(
    swipes: DataFrame, step: str = "10 minutes", watermark: str = "10 minutes", time: str = "time"
) -> DataFrame:
    """Entries and exits per station and slot of a stream of swipes.

    A slot comes out once the watermark has passed its end; ``with_open_slots`` adds the rest when
    the stream is over. Empty slots are filled in batch, on what the stream has written.
    """
    # A watermark needs a zoned time; in a UTC session the clock reading stays the same.
    events = with_direction_flags(valid_swipes(swipes)).withColumn(time, F.col(time).cast("timestamp"))
    known = events.where(F.col("stationID").isNotNull())
    slots = known.withWatermark(time, watermark).groupBy(
        "stationID", F.window(time, f"{step_seconds(step)} seconds").alias("slot")
    )
    sums = slots.agg(F.sum("inNums").alias("inNums"), F.sum("outNums").alias("outNums"))
    return sums.select(
        "stationID",
        F.col("slot.start").cast("timestamp_ntz").alias("startTime"),
        F.col("slot.end").cast("timestamp_ntz").alias("endTime"),
        "inNums",
        "outNums",
    )


def with_open_slots(closed: DataFrame, swipes: DataFrame, step: str = "10 minutes") -> DataFrame:
    """What a stream has written, and the slots that it still holds open, from a batch roll-up of the same swipes.

    For the end of a stream: the closed slots stay as they were written.
    """
    rolled = with_slot_end(observed_flow(swipes, step), step)
    still_open = rolled.join(closed.select("stationID", "startTime"), ["stationID", "startTime"], "left_anti")
    return closed.unionByName(still_open)


def late_swipes(closed: DataFrame, swipes: DataFrame, step: str = "10 minutes") -> DataFrame:
    """``stationID``, ``startTime``, ``late``: swipes of closed slots that came after their slot was written."""
    rolled = observed_flow(swipes, step).select("stationID", "startTime", (F.col("inNums") + F.col("outNums")).alias("all"))
    joined = closed.join(rolled, ["stationID", "startTime"])
    late = joined.select("stationID", "startTime", (F.col("all") - F.col("inNums") - F.col("outNums")).alias("late"))
    return late.where("late > 0")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived so far into Parquet at ``path`` and stop.

    Progress and open slots are kept at ``checkpoint``, so the next run goes on from there.
    """
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_parquet(spark: SparkSession, folder: str, pattern: str, schema: str) -> DataFrame:
    """A stream of the Parquet files of a folder whose names match the pattern."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
