"""Any event table as swipes: the ``events`` table of the test data."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def events_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _line() -> Column:
    return F.get(F.array(*[F.lit(c) for c in "ABCD"]), (F.col("user_id") % 4).cast("int"))


def _status() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "view", 1).when(kind == "click", 0).otherwise(2)


def event_swipes(spark: SparkSession, folder: str) -> DataFrame:
    return swipes_of_events(events_table(spark, folder))


def swipes_of_events(events: DataFrame) -> DataFrame:
    """Users as stations, four lines of which one has no name, views as entries, clicks as exits."""
    return events.select(
        "event_id",
        F.col("ts").alias("time"),
        F.col("user_id").alias("stationID"),
        _line().alias("lineID"),
        _status().alias("status"),
    )


def event_swipes_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """The same with whole hours as times, which makes duplicates, some null stations, and the
    two columns that cleaning drops."""
    station = F.when(F.col("event_id") % 97 != 0, F.col("user_id"))
    hour = F.window("ts", "1 hour")["start"]
    return events_table(spark, folder).select(
        hour.alias("time"),
        _line().alias("lineID"),
        station.alias("stationID"),
        F.col("event_id").cast("int").alias("deviceID"),
        _status().alias("status"),
        F.get_json_object("props", "$.k").try_cast("int").alias("payType"),
    )
