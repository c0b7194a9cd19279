"""Feature columns for the forecasts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions.timefns import is_weekend, monday_weekday, week_number
from flowgauge.operators.order import over_long_order

SLOT_BASE = ["hour", "minute", "weekday"]
DAILY_CALENDAR = ["dayOfWeek", "dayOfMonth", "isWeekend", "week_number"]
DAILY_FEATURES = [
    *DAILY_CALENDAR,
    "prev_day_in",
    "prev_day_out",
    "rolling_mean_in_7d",
    "rolling_mean_out_7d",
]


# Feature names are fixed values.
# The values that a feature can take, for its 0/1 columns.
ONEHOT_VALUES = {"hour": range(24), "minute": range(60), "weekday": range(7)}


def slot_feature_columns(stations: list[int], onehot: list[str] | None = None) -> list[str]:
    """Names in the order in which a model takes them; a one-hot feature is replaced by its columns."""
    wide = onehot or []
    unknown = set(wide) - set(ONEHOT_VALUES)
    if unknown:
        raise ValueError(f"no one-hot columns for {sorted(unknown)}")
    base = [c for name in SLOT_BASE for c in ([f"{name}_{v}" for v in ONEHOT_VALUES[name]] if name in wide else [name])]
    return base + [f"station_{s}" for s in stations]


def slot_features(
    flow: DataFrame, stations: list[int], time: str = "startTime", onehot: list[str] | None = None
) -> DataFrame:
    """Add hour, minute, weekday, weekend flag and one 0/1 column per given station.

    All given stations keep their column; any other station has zeros only. ``onehot`` adds
    one 0/1 column per value of the named features.
    """
    wide = {f"{name}_{v}": (F.col(name) == v).cast("int") for name in onehot or [] for v in ONEHOT_VALUES[name]}
    return _slot_calendar(flow, stations, time).withColumns(wide) if wide else _slot_calendar(flow, stations, time)


def _slot_calendar(flow: DataFrame, stations: list[int], time: str) -> DataFrame:
    return flow.withColumns(
        {
            "date": F.to_date(time),
            "hour": F.hour(time),
            "minute": F.minute(time),
            "weekday": monday_weekday(F.to_date(time)),
            "isWeekend": is_weekend(F.to_date(time)),
            **{f"station_{s}": (F.col("stationID") == s).cast("int") for s in stations},
        }
    )


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(
        {
            "dayOfWeek": monday_weekday(date),
            "dayOfMonth": F.dayofmonth(date),
            "isWeekend": is_weekend(date),
            "week_number": week_number(date),
        }
    )


def daily_features(daily: DataFrame, keys: list[str] | None = None, include_current: bool = True) -> DataFrame:
    """Calendar, lag and rolling columns for daily totals; one series per key.

    Without keys the table is one series, which is numbered once and taken through its windows in blocks.
    """
    frame = (-6, 0) if include_current else (-7, -1)

    def columns(window: Window) -> dict[str, Column]:
        found = {}
        for side in ("in", "out"):
            value = F.col(f"{side}Nums")
            found[f"prev_day_{side}"] = F.coalesce(F.lag(value).over(window), value)
            found[f"rolling_mean_{side}_7d"] = F.avg(value).over(window.rowsBetween(*frame))
        return found

    out = calendar_features(daily)
    if keys:
        return out.withColumns(columns(Window.partitionBy(*keys).orderBy("date")))
    return over_long_order(out, ["date"], 7, columns)


def standardize(df: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """Add each column with zero mean and unit population deviation; a constant one gives 0.

    Means and deviations are one row, read as a subquery.
    """
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
        ).alias("stats")
    ).scalar()
    scaled = {}
    for c in columns:
        mean, std = F.col(f"_stats.{c}_mean"), F.col(f"_stats.{c}_std")
        scaled[f"{c}{suffix}"] = (F.col(c) - mean) / F.when(std > 0, std).otherwise(F.lit(1.0))
    return df.withColumn("_stats", stats).withColumns(scaled).drop("_stats")
