"""Boardings by line, station and hour."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.timefns import bucket, date_text, day_name
from flowgauge.operators.lookup import with_line_name, with_station_name
from flowgauge.operators.rows import boardings
from flowgauge.operators.series import gap_fill, rolling_mean
from flowgauge.operators.spline import spline_densify
from flowgauge.sources.fixed_values import MANY_DAYS_LABEL


def line_station_profile(
    swipes: DataFrame,
    stations: DataFrame | None = None,
    lines: DataFrame | None = None,
    order: str = "by_name_max",
) -> DataFrame:
    """Boardings per line and station name, in chart order.

    Swipes are counted by id first; names are looked up on the counts. A row without a line
    name or a station name is left out.

    ``order="by_name_max"``: a name that several stations share is placed by the largest of
    their ids, on any line, whether or not the line has a name. ``order="by_id"`` places it by
    the smallest id on its own line.
    """
    if order not in ("by_name_max", "by_id"):
        raise ValueError("order must be 'by_name_max' or 'by_id'")
    by_id = boardings(swipes).groupBy("lineID", "stationID").agg(F.count(F.lit(1)).alias("count"))
    named = with_line_name(with_station_name(by_id, stations), lines).where(F.col("stationName").isNotNull())
    profile = (
        named.where(F.col("lineName").isNotNull())
        .groupBy("lineName", "stationName")
        .agg(F.sum("count").alias("count"), F.min("stationID").alias("station_order"))
    )
    if order == "by_name_max":
        places = named.groupBy("stationName").agg(F.max("stationID").alias("station_order"))
        profile = profile.drop("station_order").join(places, "stationName", "left")
    return profile.select("lineName", "stationName", "count", "station_order").orderBy("lineName", "station_order")


def line_hourly_counts(swipes: DataFrame, lines: DataFrame | None = None, time: str = "time") -> DataFrame:
    """Boardings per line and hour, from the first to the last hour seen on the line."""
    by_id = (
        boardings(swipes)
        .where(F.col(time).isNotNull() & F.col("lineID").isNotNull())
        .groupBy("lineID", bucket(time, "1 hour").alias("time"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    named = with_line_name(by_id, lines).where(F.col("lineName").isNotNull())
    hourly = named.groupBy("lineName", "time").agg(F.sum("count").alias("count"))
    return gap_fill(hourly, ["lineName"], "time", "1 hour", ["count"], bounds="group")


def line_hourly_profile(swipes: DataFrame, lines: DataFrame | None = None, time: str = "time") -> DataFrame:
    """Hourly boardings per line with their mean over three hours."""
    hourly = line_hourly_counts(swipes, lines, time)
    return rolling_mean(hourly, ["lineName"], "time", "count", 3, "count_smoothed")


def line_hourly_curve(hourly: DataFrame, n: int = 300) -> DataFrame:
    """Smooth curve of ``n`` points through each line's smoothed hourly counts."""
    return spline_densify(hourly, "lineName", "time", "count_smoothed", n)


def date_label(df: DataFrame, time: str = "time", by: list[str] | None = None) -> DataFrame:
    """Title date: day and English day name if all rows are of one day, else the many-days label."""
    by = by or []
    first, last = F.to_date(F.min(time)), F.to_date(F.max(time))
    days = df.groupBy(*by).agg(first.alias("_first"), last.alias("_last"))
    one_day = F.concat(date_text("_first"), F.lit(" ("), day_name("_first"), F.lit(")"))
    label = F.when(F.col("_first") == F.col("_last"), one_day).otherwise(F.lit(MANY_DAYS_LABEL))
    return days.select(*by, label.alias("title_date"))
