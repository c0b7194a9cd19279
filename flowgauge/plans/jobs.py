"""The four whole jobs, from files to files: roll-up, profiles, slot forecast, daily forecast."""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.models.competition import TARGETS, Fitted, fit_daily_models, fit_slot_models, save_models
from flowgauge.models.estimators import Candidate
from flowgauge.models.forecast import forecast_recursive, forecast_slots, model_predictor
from flowgauge.operators.features import daily_features
from flowgauge.operators.flow import daily_totals, union_all
from flowgauge.operators.lookup import with_station_label
from flowgauge.operators.quality import (
    audit_of_copies,
    drop_incomplete,
    missing_days,
    rollup_audit,
    unmapped,
    with_copies,
)
from flowgauge.operators.rows import boardings, drop_columns, for_stations, is_empty
from flowgauge.operators.stats import describe_exact
from flowgauge.plans.profiles import date_label, line_hourly_curve, line_hourly_profile, line_station_profile
from flowgauge.plans.report import build_report
from flowgauge.plans.rollup import station_flow
from flowgauge.sources.dims import line_dim, station_dim, target_label_dim
from flowgauge.sources.fixed_values import TARGET_STATIONS, UNUSED_COLUMNS
from flowgauge.sources.ledger import file_ledger
from flowgauge.sources.readers import days_with_files, read_days, read_flow, read_swipes, skipped_files
from flowgauge.sources.schemas import FLOW
from flowgauge.sources.sinks import write_chart_feed, write_flow, write_forecast, write_report


def run_rollup(
    spark: SparkSession,
    raw: str,
    out: str,
    start: datetime.date,
    end: datetime.date,
    step: str = "10 minutes",
    fmt: str = "parquet",
) -> DataFrame:
    """Roll the swipe files of a range of days up into a flow table; returns the days without any.

    All days are one roll-up, so a station counts 0 on a day on which it has no swipe. Beside the
    flow, in folders that readers pass over, stand the counts of swipes left out (``_audit``), all
    files with their rows (``_files``) and those left out (``_skipped``). The days are known from the paths of the files that were
    read: a day whose files were all left out counts as one without any.
    """
    ledger = file_ledger(spark, raw, start, end)
    swipes = read_days(spark, raw, start, end, ledger=ledger)
    if is_empty(swipes):
        raise ValueError(f"no swipes from {start} to {end} in {raw}")
    write_flow(station_flow(swipes, step), out, fmt)
    rollup_audit(swipes).write.mode("overwrite").parquet(f"{out}/_audit")
    ledger.write.mode("overwrite").parquet(f"{out}/_files")
    skipped_files(ledger).write.mode("overwrite").parquet(f"{out}/_skipped")
    return missing_days(days_with_files(ledger), start, end)


def run_profiles(spark: SparkSession, raw: str, out: str) -> None:
    """Clean swipes and write the tables behind the station and hour charts, with their checks.

    Rows and their copies are counted once; the audit and the cleaned rows both come from that.
    """
    counted = with_copies(drop_columns(read_swipes(spark, raw), UNUSED_COLUMNS)).persist()
    try:
        audit_of_copies(counted).write.mode("overwrite").parquet(f"{out}/audit")
        cleaned = drop_incomplete(counted.drop("_copies"))
        entered = boardings(cleaned)
        unmapped(entered, station_dim(spark), "stationID").write.mode("overwrite").parquet(f"{out}/unmapped_stations")
        unmapped(entered, line_dim(spark), "lineID").write.mode("overwrite").parquet(f"{out}/unmapped_lines")
        write_chart_feed(line_station_profile(cleaned), f"{out}/stations", ["lineName"])
        hourly = line_hourly_profile(cleaned)
        date_label(hourly).write.mode("overwrite").parquet(f"{out}/title")
        write_chart_feed(hourly, f"{out}/hours", ["lineName"])
        write_chart_feed(line_hourly_curve(hourly), f"{out}/curves", ["lineName"])
    finally:
        counted.unpersist()


def run_slot_forecast(
    spark: SparkSession,
    flow: str,
    out: str,
    start: datetime.date,
    end: datetime.date,
    base: datetime.date,
    days: int = 5,
    stations: list[int] | None = None,
    step: str = "10 minutes",
    candidates: dict[str, Candidate] | None = None,
    fmt: str = "parquet",
    split: str = "random",
    onehot: list[str] | None = None,
) -> Fitted:
    """Fit on the flow of ``start..end`` and forecast the slots of ``days`` days from ``base`` on.

    Writes the forecast, its description, the scores, the models and a chart table per station
    and day. Every asked-for station is forecast; ``without_history`` lists those that have no flow
    in the range, whose numbers come from the calendar alone.
    """
    stations = stations or TARGET_STATIONS
    history = read_flow(spark, flow, start, end, fmt)
    fitted = fit_slot_models(history, stations, candidates, split=split, onehot=onehot)
    fitted.leaderboard.write.mode("overwrite").parquet(f"{out}/leaderboard")
    save_models(fitted, f"{out}/models")
    asked = spark.createDataFrame([(s,) for s in dict.fromkeys(stations)], "stationID bigint")
    known = for_stations(history, stations).select("stationID").distinct()
    asked.join(known, "stationID", "left_anti").write.mode("overwrite").parquet(f"{out}/without_history")
    scored = forecast_slots(fitted.models, asked, F.lit(base), days, stations, step, onehot=onehot)
    write_forecast(scored, f"{out}/forecast")
    # Scored once: the description and the charts read what was written.
    forecast = spark.read.schema(FLOW).option("header", True).csv(f"{out}/forecast")
    describe_exact(forecast, TARGETS).write.mode("overwrite").parquet(f"{out}/description")
    charts = with_station_label(forecast, F.broadcast(target_label_dim(spark))).withColumn("date", F.to_date("startTime"))
    write_chart_feed(charts, f"{out}/charts", ["stationID", "date"])
    return fitted


def run_daily_forecast(
    spark: SparkSession,
    flow: str,
    out: str,
    start: datetime.date,
    end: datetime.date,
    horizon: int = 6,
    roll: str = "frozen",
    candidates: dict[str, Candidate] | None = None,
    fmt: str = "parquet",
) -> Fitted:
    """Fit on the daily totals of ``start..end`` and forecast the ``horizon`` days after.

    Writes the daily totals, the report, the scores, the models and the chart table of actual and
    forecast days. The totals are made once; all that follows reads them.
    """
    daily_totals(read_flow(spark, flow, start, end, fmt)).write.mode("overwrite").parquet(f"{out}/daily")
    daily = spark.read.parquet(f"{out}/daily")
    fitted = fit_daily_models(daily, candidates)
    fitted.leaderboard.write.mode("overwrite").parquet(f"{out}/leaderboard")
    save_models(fitted, f"{out}/models")
    actual = daily_features(daily)
    forecast = forecast_recursive(daily, model_predictor(fitted.models), horizon, roll=roll)
    write_report(build_report(actual, forecast), f"{out}/report")
    both = union_all([actual.withColumn("isPrediction", F.lit(False)), forecast])
    write_chart_feed(both.select("date", *TARGETS, "isPrediction"), f"{out}/charts", ["isPrediction"])
    return fitted
