
from __future__ import annotations

import datetime
import gzip
from collections.abc import Callable

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgauge.functions.timefns import bucket, date_text, parse_time, time_text, two_digits
from flowgauge.models.competition import TARGETS, fit_daily_models, fit_slot_models, predict
from flowgauge.models.estimators import KernelRegression, fit_labels, kernel_draws
from flowgauge.models.forecast import forecast_recursive, forecast_slots, linear_predictor, model_predictor
from flowgauge.models.normal_equations import linear_cv
from flowgauge.operators.features import DAILY_FEATURES, daily_features, slot_features, standardize
from flowgauge.operators.flow import daily_totals, merge_directions, union_all
from flowgauge.operators.lookup import with_line_name, with_station_label, with_station_name
from flowgauge.operators.quality import missing_days, quality_audit, rollup_audit, unmapped
from flowgauge.operators.order import with_row_number
from flowgauge.operators.rows import (
    align_columns,
    boardings,
    day_slice,
    drop_columns,
    first_rows,
    for_stations,
    last_row,
    last_rows,
    split_day_type,
    valid_swipes,
    with_direction_flags,
)
from flowgauge.operators.sampling import contiguous_folds, split_hash, with_test_flag
from flowgauge.operators.series import calendar_spine, flow_by_slot, linspace_grid, slot_grid
from flowgauge.operators.stats import best_model, describe_exact, fold_summary, regression_metrics, tail_mean
from flowgauge.plans.cleaning import clean_swipes
from flowgauge.plans.incremental import kept_flow, update_days
from flowgauge.plans.profiles import (
    date_label,
    line_hourly_counts,
    line_hourly_curve,
    line_hourly_profile,
    line_station_profile,
)
from flowgauge.plans.report import build_report
from flowgauge.plans.rollup import daily_flow, observed_flow, station_flow
from flowgauge.session import scratch_path
from flowgauge.sources.dims import line_dim, station_dim, target_label_dim
from flowgauge.sources.events import event_swipes, event_swipes_dirty, events_table, swipes_of_events
from flowgauge.sources.fixed_values import (
    ACTUAL_LABEL,
    FORECAST_LABEL,
    LINE_NAMES,
    MANY_DAYS_LABEL,
    REPORT_COLUMNS,
    STATION_NAMES,
    STATION_PREFIX,
    TARGET_STATION_LABELS,
    TARGET_STATIONS,
    UNUSED_COLUMNS,
    WEEKDAY_LABELS,
)
from flowgauge.sources.readers import read_days, read_flow, read_report, read_swipes
from flowgauge.sources.sinks import write_bytes, write_chart_feed, write_flow, write_forecast, write_report, write_swipes
from flowgauge.streaming.flow_stream import flow_stream, run_available, stream_parquet, with_open_slots

HORIZON_DAYS = 5
RECURSIVE_DAYS = 6

# Elimination without pivots, as in the SQL counterpart, needs a ridge where features depend on each other.
CV_RIDGE = 1e-6
KERNEL_WAVES = 8

# Coefficients of the recursive forecast that has an SQL counterpart; binary fractions, so that
# both engines compute the same doubles.
ENTRY_LINE = {"": 1.0, "prev_day_in": 0.5, "rolling_mean_in_7d": 0.25, "isWeekend": 2.0}
EXIT_LINE = {"": 0.5, "prev_day_out": 0.75, "rolling_mean_out_7d": 0.125, "dayOfWeek": 0.25}


# The same for slots, as SQL that both engines read alike.
SLOT_LINES = {
    ("weekday", "inNums"): "0.5 + 0.25 * hour - 0.125 * weekday",
    ("weekday", "outNums"): "4.0 - 0.5 * hour + 0.0625 * minute",
    ("weekend", "inNums"): "2.5 + 0.5 * station_10",
    ("weekend", "outNums"): "0.25 * weekday - 0.03125 * minute",
}


def entry(spark: SparkSession) -> DataFrame:
    """Dense entries and exits per station and ten minutes."""
    return _station_flow(spark, "/root/testdata/sf0.001")


# ---------------------------------------------------------------- inputs


def _station_flow(spark: SparkSession, sf: str) -> DataFrame:
    return station_flow(event_swipes(spark, sf))


def _kept_flow(spark: SparkSession, sf: str) -> DataFrame:
    """The dense table, made once and written, for queries that read it several times."""
    path = scratch_path(spark, "flow")
    _station_flow(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def _raw_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return drop_columns(event_swipes_dirty(spark, sf), UNUSED_COLUMNS)


def _daily(spark: SparkSession, sf: str, keys: list[str] | None = None) -> DataFrame:
    return daily_flow(event_swipes(spark, sf), keys)


def _next_day(spark: SparkSession, sf: str) -> Column:
    """The day after the last swipe, as a one-row subquery."""
    last = valid_swipes(event_swipes(spark, sf)).agg(F.to_date(F.max("time")).alias("d"))
    return F.date_add(last.scalar(), 1)


def _stations(spark: SparkSession, sf: str) -> DataFrame:
    return valid_swipes(event_swipes(spark, sf)).select("stationID").distinct()


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# ---------------------------------------------------------------- sources and sinks


def swipes_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Swipes out to CSV and back through the declared schema, found by column name."""
    path = scratch_path(spark, "swipes")
    write_swipes(event_swipes(spark, sf).select("time", "lineID", "stationID", "status"), path)
    return read_swipes(spark, path).select("time", "lineID", "stationID", "status")


def read_days_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """One folder of CSV per day, read as a range of days; each row tagged with its file's day."""
    path = scratch_path(spark, "days")
    swipes = event_swipes(spark, sf).select("time", "lineID", "stationID", "status")
    by_day = swipes.withColumn("day", F.to_date("time")).hint("rebalance", F.col("day"))
    by_day.write.partitionBy("day").option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)
    first, last = datetime.date(1970, 1, 1), datetime.date(9999, 12, 31)
    return read_days(spark, path, first, last).select("date", "time", "lineID", "stationID", "status")


def read_days_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """A folder as it comes: days with their columns in another order or compressed, a file without a day, one that is no
    swipe file, one that is cut off behind its first rows."""
    path = scratch_path(spark, "mixed")
    swipes = event_swipes(spark, sf).select("time", "lineID", "stationID", "status").withColumn("day", F.to_date("time"))
    odd = F.dayofmonth("day") % 2 == 1

    def put(df: DataFrame, folder: str, compression: str = "none") -> None:
        df.hint("rebalance", F.col("day")).write.partitionBy("day").option("header", True).option(
            "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
        ).option("compression", compression).csv(f"{path}/{folder}")

    put(swipes.where(odd), "first")
    put(swipes.where(~odd).select("status", "stationID", "time", "lineID", "day"), "second", "gzip")
    put(swipes.select(F.col("stationID").alias("station"), "day").distinct(), "third")
    swipes.drop("day").limit(10).write.option("header", True).csv(f"{path}/extra")
    lines = [f"2024-01-03 08:{i // 60 % 60:02d}:{i % 60:02d},{'ABC'[i % 3]},{i % 81},{i % 2}\n" for i in range(20_000)]
    whole = gzip.compress(f"time,lineID,stationID,status\n{''.join(lines)}".encode())
    write_bytes(spark, f"{path}/fourth/record_2024-01-03.csv.gz", whole[: len(whole) // 2])
    first, last = datetime.date(1970, 1, 1), datetime.date(9999, 12, 31)
    return read_days(spark, path, first, last).select("date", "time", "lineID", "stationID", "status")


def rollup_by_days(spark: SparkSession, sf: str) -> DataFrame:
    """Day files rolled up all but a late one, then that one and one again; sums and slots per station and day."""
    path, out = scratch_path(spark, "days"), scratch_path(spark, "kept")
    swipes = event_swipes(spark, sf).select("time", "lineID", "stationID", "status").withColumn("day", F.to_date("time"))
    swipes.hint("rebalance", F.col("day")).write.partitionBy("day").option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)
    first, last = datetime.date(1970, 1, 1), datetime.date(9999, 12, 31)
    late = datetime.date(2024, 1, 9)
    update_days(spark, path, out, first, late - datetime.timedelta(days=1))
    update_days(spark, path, out, late + datetime.timedelta(days=1), last)
    for _ in range(2):
        update_days(spark, path, out, late, late)
    dated = kept_flow(spark, out).withColumn("date", F.to_date("startTime"))
    sums = [F.count(F.lit(1)).alias("slots"), *[F.sum(c).alias(c) for c in TARGETS]]
    return dated.groupBy("stationID", "date").agg(*sums)


def flow_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "flow")
    write_flow(_station_flow(spark, sf), path, "csv", compression="gzip")
    return read_flow(spark, path, fmt="csv")


def flow_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "flow")
    write_flow(_station_flow(spark, sf), path)
    return read_flow(spark, path)


def forecast_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Slot rows out to compressed CSV with times as text, and back as text."""
    path = scratch_path(spark, "forecast")
    write_forecast(_station_flow(spark, sf), path, compression="gzip")
    schema = "stationID bigint, startTime string, endTime string, inNums bigint, outNums bigint"
    return spark.read.schema(schema).option("header", True).csv(path)


def report_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "report")
    write_report(report(spark, sf), path)
    return read_report(spark, path)


def chart_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Table behind one chart per line: written in one folder per line, read back."""
    path = scratch_path(spark, "chart")
    write_chart_feed(line_station_profile(event_swipes(spark, sf)), path, ["lineName"])
    kinds = "stationName string, count bigint, station_order bigint, lineName string"
    return spark.read.schema(kinds).parquet(path)


# ---------------------------------------------------------------- cleaning and lookups


def unmapped_lines(spark: SparkSession, sf: str) -> DataFrame:
    return unmapped(boardings(event_swipes(spark, sf)), line_dim(spark), "lineID")


def unmapped_stations(spark: SparkSession, sf: str) -> DataFrame:
    return unmapped(boardings(event_swipes(spark, sf)), station_dim(spark), "stationID")


def station_names(spark: SparkSession, sf: str) -> DataFrame:
    swipes = event_swipes(spark, sf)
    named = with_station_name(with_station_label(swipes))
    chart = target_label_dim(spark).withColumnRenamed("stationName", "chartLabel")
    return named.join(F.broadcast(chart), "stationID", "left").select(
        "event_id", "stationID", "stationName", "stationLabel", "chartLabel"
    )


def line_names(spark: SparkSession, sf: str) -> DataFrame:
    return with_line_name(event_swipes(spark, sf)).select("event_id", "lineID", "lineName")


def missing_station_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days on which a station has no swipe, within the days of the whole table."""
    days = event_swipes(spark, sf).select("stationID", F.to_date("time").alias("date")).distinct()
    first, last = days.agg(F.min("date")).scalar(), days.agg(F.max("date")).scalar()
    return missing_days(days, first, last, keys=["stationID"])


def parsed_times(spark: SparkSession, sf: str) -> DataFrame:
    """Times from text, some of which is none."""
    text = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("at "), time_text("ts"))).otherwise(time_text("ts"))
    return events_table(spark, sf).select("event_id", parse_time(text).alias("time"))


def slot_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Swipes per slot of the day, the slot as zero-padded hours and minutes."""
    slot = bucket("time", "10 minutes")
    label = F.concat(two_digits(F.hour(slot)), F.lit(":"), two_digits(F.minute(slot)))
    return event_swipes(spark, sf).groupBy(label.alias("slot")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- flow


def merge_directions_query(spark: SparkSession, sf: str) -> DataFrame:
    flagged = with_direction_flags(valid_swipes(event_swipes(spark, sf)))
    ins = flow_by_slot(flagged.where("inNums = 1")).select("stationID", "startTime", "inNums")
    outs = flow_by_slot(flagged.where("outNums = 1")).select("stationID", "startTime", "outNums")
    return merge_directions(ins, outs)


def calendar_spine_query(spark: SparkSession, sf: str) -> DataFrame:
    swipes = valid_swipes(event_swipes(spark, sf))
    slots = swipes.withColumn("startTime", bucket("time", "1 hour"))
    return calendar_spine(slots, ["stationID"], "startTime", "1 hour")


def date_label_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """The title of each day's chart, as when one day's file is charted."""
    dated = boardings(event_swipes(spark, sf)).withColumn("date", F.to_date("time"))
    return date_label(dated, by=["date"])


# ---------------------------------------------------------------- features, splits, scores


def _all_slot_features(spark: SparkSession, sf: str) -> DataFrame:
    return slot_features(_station_flow(spark, sf), TARGET_STATIONS)


def slot_features_query(spark: SparkSession, sf: str) -> DataFrame:
    return _all_slot_features(spark, sf).drop("endTime")


def aligned_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features put in a model's column order; a column the table lacks is zero."""
    columns = ["startTime", "stationID", "hour", "minute", "weekday", "station_10", "station_absent"]
    return align_columns(_all_slot_features(spark, sf), columns)


def day_type_rows(spark: SparkSession, sf: str, part: int) -> DataFrame:
    dated = _station_flow(spark, sf).withColumn("date", F.to_date("startTime"))
    return split_day_type(dated)[part]


def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["hour", "minute", "weekday", "station_10", "inNums"]
    scaled = standardize(slot_features(_kept_flow(spark, sf), TARGET_STATIONS), columns)
    # Six decimals by floor, which costs a fraction of decimal rounding on this many rows.
    values = [(F.floor(F.col(f"{c}_z") * 1e6 + 0.5) / 1e6).alias(f"{c}_z") for c in columns]
    return scaled.select("stationID", "startTime", *values)


def split_exact_query(spark: SparkSession, sf: str) -> DataFrame:
    flagged = with_test_flag(_station_flow(spark, sf), ["stationID", "startTime"])
    return flagged.select("stationID", "startTime", "inNums", "outNums", "is_test")


def split_hash_query(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each side of the hash split."""
    train, test = split_hash(_station_flow(spark, sf), ["stationID", "startTime"])
    sides = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return sides.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), F.sum("inNums").alias("inNums"))


def regression_metrics_query(spark: SparkSession, sf: str) -> DataFrame:
    """Error of the station mean as a prediction, per station."""
    mean = F.avg("inNums").over(Window.partitionBy("stationID"))
    guessed = _station_flow(spark, sf).withColumn("prediction", mean)
    scores = regression_metrics(guessed, "inNums", "prediction", ["stationID"])
    return _rounded(scores, 8, "mse", "rmse", "r2")


def linear_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Least squares lines of entries and exits on hour, minute and weekday, over all slots, in one aggregation."""
    slots = slot_features(_station_flow(spark, sf), [])
    lines = [
        F.struct(
            F.lit(target).alias("target"),
            F.lit(feature).alias("feature"),
            F.regr_slope(target, feature).alias("slope"),
            F.regr_intercept(target, feature).alias("intercept"),
        )
        for target in TARGETS
        for feature in ("hour", "minute", "weekday")
    ]
    rows = slots.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))
    return _rounded(rows, 8, "slope", "intercept")


def linear_cv_query(spark: SparkSession, sf: str) -> DataFrame:
    """Least squares on the daily features of all stations, scored on five folds of days, from one aggregation."""
    table = daily_features(_daily(spark, sf, ["stationID"]), ["stationID"])
    return _rounded(linear_cv(table, DAILY_FEATURES, TARGETS, ridge=CV_RIDGE), 6, "mse", "rmse", "r2")


def kernel_waves(spark: SparkSession, sf: str) -> DataFrame:
    """The random waves that stand for the kernel, of the daily features of all stations."""
    table = daily_features(_daily(spark, sf, ["stationID"]), ["stationID"])
    estimator = KernelRegression(DAILY_FEATURES, "inNums", size=KERNEL_WAVES)
    waves = F.transform("waves", lambda w: F.round(w, 8))
    return estimator.waves(table).transform(table).select("stationID", "date", F.posexplode(waves).alias("wave", "value"))


def support_vector_days(spark: SparkSession, sf: str) -> DataFrame:
    """Support vector regression of daily entries and exits of all stations, as predictions."""
    table = daily_features(_daily(spark, sf, ["stationID"]), ["stationID"])
    models = fit_labels(table, [KernelRegression(DAILY_FEATURES, target, loss="epsilon") for target in TARGETS])
    for target, model in zip(TARGETS, models, strict=True):
        table = predict(table, model, f"{target}_fit")
    return table.select("stationID", "date", *TARGETS, *[f"{target}_fit" for target in TARGETS])


def baseline_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Two plain predictions of a station's daily entries, scored on five folds: its mean and the mean of all stations,
    both over the other folds."""
    folded = contiguous_folds(_daily(spark, sf, ["stationID"]), "date")
    scores = []
    for place, (model, keys) in enumerate({"overall_mean": [], "station_mean": ["stationID"]}.items()):
        cells = folded.groupBy(*keys, "fold").agg(F.sum("inNums").alias("s"), F.count(F.lit(1)).alias("n"))
        every = Window.partitionBy(*keys)
        rest = (F.sum("s").over(every) - F.col("s")) / (F.sum("n").over(every) - F.col("n"))
        guessed = folded.join(cells.select(*keys, "fold", rest.alias("prediction")), [*keys, "fold"])
        own = regression_metrics(guessed, "inNums", "prediction", ["fold"])
        names = {"target": F.lit("inNums"), "model": F.lit(model), "place": F.lit(place)}
        scores.append(own.withColumns(names))
    summary = fold_summary(union_all(scores), ["target", "model", "place"])
    return _rounded(summary, 6, "r2_mean", "r2_std", "rmse_mean", "rmse_std")


def baseline_winner(spark: SparkSession, sf: str) -> DataFrame:
    """The better of the two plain predictions by its mean R2."""
    return best_model(baseline_leaderboard(spark, sf), "r2_mean", ["target"], "place", highest=True)


def observed_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Observed slots with their place in the order of station and time, in which flow is written."""
    return with_row_number(observed_flow(event_swipes(spark, sf)), ["stationID", "startTime"], "place")


def profile_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Boardings per line and station name with their place in chart order."""
    profile = line_station_profile(event_swipes(spark, sf))
    return with_row_number(profile, ["lineName", "station_order", "stationName"], "place")


# ---------------------------------------------------------------- forecasts


def forecast_grid(spark: SparkSession, sf: str) -> DataFrame:
    return slot_grid(_stations(spark, sf), _next_day(spark, sf), HORIZON_DAYS)


def slot_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out error of every candidate for weekdays and weekends, entries and exits."""
    return fit_slot_models(_station_flow(spark, sf), TARGET_STATIONS).leaderboard


def forecast_slots_query(spark: SparkSession, sf: str) -> DataFrame:
    """The five days after the last swipe, by the winning models, for the target stations."""
    fitted = fit_slot_models(_station_flow(spark, sf), TARGET_STATIONS)
    stations = for_stations(_stations(spark, sf), TARGET_STATIONS)
    return forecast_slots(fitted.models, stations, _next_day(spark, sf), HORIZON_DAYS, TARGET_STATIONS)


def forecast_slots_linear(spark: SparkSession, sf: str) -> DataFrame:
    """The five days after the last swipe for all stations, by given lines in place of fitted models."""
    models = {
        (day_type, target): SQLTransformer(statement=f"SELECT *, {line} AS prediction FROM __THIS__")
        for (day_type, target), line in SLOT_LINES.items()
    }
    return forecast_slots(models, _stations(spark, sf), _next_day(spark, sf), HORIZON_DAYS, TARGET_STATIONS)


def daily_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and deviation of R2 and RMSE over five folds, per candidate."""
    return fit_daily_models(_daily(spark, sf)).leaderboard


def best_models(spark: SparkSession, sf: str) -> DataFrame:
    """The candidate that forecasts each daily series."""
    return fit_daily_models(_daily(spark, sf)).winners


def forecast_recursive_query(spark: SparkSession, sf: str) -> DataFrame:
    """The six days after the last one, by the winning daily models."""
    daily = _daily(spark, sf)
    fitted = fit_daily_models(daily)
    return forecast_recursive(daily, model_predictor(fitted.models), RECURSIVE_DAYS)


def recursive_linear(spark: SparkSession, sf: str) -> DataFrame:
    """Every station's next six days, from given lines instead of fitted models."""
    predictor = linear_predictor(ENTRY_LINE, EXIT_LINE)
    return forecast_recursive(_daily(spark, sf, ["stationID"]), predictor, RECURSIVE_DAYS, ["stationID"])


def _tail_mean_forecast(spark: SparkSession, sf: str) -> DataFrame:
    predictor = linear_predictor({"rolling_mean_in_7d": 1.0}, {"rolling_mean_out_7d": 1.0})
    return forecast_recursive(_daily(spark, sf), predictor, RECURSIVE_DAYS)


def report(spark: SparkSession, sf: str) -> DataFrame:
    """Actual days and six forecast days (mean of the last seven) as formatted text."""
    return build_report(daily_features(_daily(spark, sf)), _tail_mean_forecast(spark, sf))


def describe_flow(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(describe_exact(_station_flow(spark, sf), TARGETS), 8, "mean", "std")


def tail_mean_query(spark: SparkSession, sf: str) -> DataFrame:
    means = tail_mean(_daily(spark, sf, ["stationID"]), "date", TARGETS, 7, ["stationID"])
    return _rounded(means, 8, *TARGETS)


# ---------------------------------------------------------------- streaming


def flow_stream_query(spark: SparkSession, sf: str) -> DataFrame:
    """The roll-up as a stream over the event file: closed slots, and at its end those still open."""
    kinds = ", ".join(f"{name} {kind}" for name, kind in events_table(spark, sf).dtypes)
    events = stream_parquet(spark, sf, "events.parquet", kinds)
    path = scratch_path(spark, "stream")
    run_available(flow_stream(swipes_of_events(events)), f"{path}/flow", f"{path}/progress")
    return with_open_slots(spark.read.parquet(f"{path}/flow"), event_swipes(spark, sf))


def _corpus() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries of the corpus operators and their SQL; nothing where that subpackage is left out."""
    try:
        import corpus_pipeline
        from flowgauge.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as missing:
        if not str(missing.name).startswith(("flowgauge.llm", "corpus_pipeline")):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return QUERIES | {"pipeline": corpus_pipeline.run}, ORACLES | sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries; each reads its whole tables."""
    return flow_queries() | _corpus()[0]


def oracle_sql() -> dict[str, str]:
    """DuckDB statements of all queries that SQL can express."""
    return flow_oracles() | _corpus()[1]


def flow_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries of the flow operators."""

    def on_swipes(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf: operator(event_swipes(spark, sf))

    def with_text_dates(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        """Dates leave a query as text, which reads the same in every engine."""

        def run(spark: SparkSession, sf: str) -> DataFrame:
            df = query(spark, sf)
            return df.withColumns({c: date_text(c).alias(c) for c, kind in df.dtypes if kind == "date"})

        return run

    registered = {
        # Sources and sinks
        "swipes_csv_roundtrip": swipes_csv_roundtrip,
        "read_days_roundtrip": read_days_roundtrip,
        "read_days_mixed": read_days_mixed,
        "rollup_by_days": rollup_by_days,
        "flow_csv_roundtrip": flow_csv_roundtrip,
        "flow_parquet_roundtrip": flow_parquet_roundtrip,
        "forecast_csv_roundtrip": forecast_csv_roundtrip,
        "report_csv_roundtrip": report_csv_roundtrip,
        "chart_feed": chart_feed,
        # Cleaning, filters and lookups
        "clean_swipes": lambda spark, sf: clean_swipes(event_swipes_dirty(spark, sf)),
        "rollup_audit": lambda spark, sf: rollup_audit(event_swipes_dirty(spark, sf)),
        "parsed_times": parsed_times,
        "slot_labels": slot_labels,
        "quality_audit": lambda spark, sf: quality_audit(_raw_dirty(spark, sf)),
        "valid_swipes": on_swipes(lambda df: with_direction_flags(valid_swipes(df))),
        "boardings": on_swipes(boardings),
        "station_names": station_names,
        "line_names": line_names,
        "unmapped_stations": unmapped_stations,
        "unmapped_lines": unmapped_lines,
        "missing_days": missing_station_days,
        "first_rows": on_swipes(lambda df: first_rows(df, ["time", "event_id"])),
        # Flow tables
        "station_flow": _station_flow,
        "observed_flow": on_swipes(observed_flow),
        "merge_directions": merge_directions_query,
        "flow_group_bounds": on_swipes(lambda df: station_flow(df, bounds="group")),
        "calendar_spine": calendar_spine_query,
        "target_stations": on_swipes(lambda df: station_flow(df, stations=TARGET_STATIONS)),
        "named_station_flow": lambda spark, sf: station_flow(event_swipes(spark, sf), stations=station_dim(spark)),
        "day_slice": lambda spark, sf: day_slice(_station_flow(spark, sf), 10, datetime.date(2024, 1, 15)),
        "weekday_rows": lambda spark, sf: day_type_rows(spark, sf, 0),
        "weekend_rows": lambda spark, sf: day_type_rows(spark, sf, 1),
        "describe_flow": describe_flow,
        # Profiles
        "line_station_profile": on_swipes(line_station_profile),
        "line_station_profile_by_id": on_swipes(lambda df: line_station_profile(df, order="by_id")),
        "line_hourly": on_swipes(line_hourly_counts),
        "line_hourly_smoothed": on_swipes(lambda df: _rounded(line_hourly_profile(df), 8, "count_smoothed")),
        "line_time_grid": on_swipes(lambda df: linspace_grid(line_hourly_counts(df), "lineName", "time")),
        "line_hourly_spline": on_swipes(lambda df: _rounded(line_hourly_curve(line_hourly_profile(df)), 6, "count_smoothed")),
        "date_label": on_swipes(lambda df: date_label(line_hourly_counts(df))),
        "date_label_by_day": date_label_by_day,
        # Daily tables
        "daily_totals": lambda spark, sf: daily_totals(_station_flow(spark, sf)),
        "daily_flow": _daily,
        "station_daily_flow": lambda spark, sf: _daily(spark, sf, ["stationID"]),
        "daily_features": lambda spark, sf: _rounded(
            daily_features(_daily(spark, sf)), 8, "rolling_mean_in_7d", "rolling_mean_out_7d"
        ),
        "station_daily_features": lambda spark, sf: _rounded(
            daily_features(_daily(spark, sf, ["stationID"]), ["stationID"]),
            8,
            "rolling_mean_in_7d",
            "rolling_mean_out_7d",
        ),
        "last_days": lambda spark, sf: last_rows(_daily(spark, sf, ["stationID"]), "date", 7, ["stationID"]),
        "last_day": lambda spark, sf: last_row(_daily(spark, sf, ["stationID"]), "date", ["stationID"]),
        "tail_mean": tail_mean_query,
        # Features, splits and scores
        "slot_features": slot_features_query,
        "aligned_features": aligned_features,
        "scaled_features": scaled_features,
        "split_exact": split_exact_query,
        "split_hash": split_hash_query,
        "folds": lambda spark, sf: contiguous_folds(_daily(spark, sf), "date"),
        "regression_metrics": regression_metrics_query,
        "observed_in_order": observed_in_order,
        "profile_in_order": profile_in_order,
        "linear_trend": linear_trend,
        "linear_cv": linear_cv_query,
        "kernel_waves": kernel_waves,
        "support_vector_days": support_vector_days,
        "baseline_leaderboard": baseline_leaderboard,
        "baseline_winner": baseline_winner,
        # Models and forecasts
        "slot_leaderboard": slot_leaderboard,
        "daily_leaderboard": daily_leaderboard,
        "best_models": best_models,
        "forecast_grid": forecast_grid,
        "forecast_slots": forecast_slots_query,
        "forecast_slots_linear": forecast_slots_linear,
        "recursive_linear": recursive_linear,
        "forecast_recursive": forecast_recursive_query,
        "report": report,
        # Streaming
        "flow_stream": flow_stream_query,
    }
    return {name: with_text_dates(query) for name, query in registered.items()}


# ---------------------------------------------------------------- SQL counterparts


def _values(rows: dict | list) -> str:
    pairs = rows.items() if isinstance(rows, dict) else enumerate(rows)
    return ", ".join(f"({k!r}, '{v}')" for k, v in pairs)


_LINE = "CASE user_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END"
_STATUS = "CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 0 ELSE 2 END AS INTEGER)"

_STEPS = {
    "swipes": f"""SELECT event_id, ts AS "time", user_id AS "stationID", {_LINE} AS "lineID", {_STATUS} AS status
        FROM events""",
    "dirty": f"""SELECT date_trunc('hour', ts) AS "time", {_LINE} AS "lineID",
        CASE WHEN event_id % 97 <> 0 THEN user_id END AS "stationID", {_STATUS} AS status FROM events""",
    "valid": """SELECT *, CAST(status = 1 AS BIGINT) AS "inNums", CAST(status = 0 AS BIGINT) AS "outNums"
        FROM swipes WHERE status IN (0, 1)""",
    "observed": """SELECT "stationID", time_bucket(INTERVAL 10 MINUTE, "time", TIMESTAMP '2000-01-01') AS "startTime",
        CAST(sum("inNums") AS BIGINT) AS "inNums", CAST(sum("outNums") AS BIGINT) AS "outNums"
        FROM valid GROUP BY 1, 2""",
    "days": """SELECT CAST(unnest(generate_series(date_trunc('day', min("time")), date_trunc('day', max("time")),
        INTERVAL 1 DAY)) AS TIMESTAMP) AS "day" FROM valid""",
    "slots": """SELECT unnest(generate_series("day", "day" + INTERVAL 1430 MINUTE, INTERVAL 10 MINUTE))
        AS "startTime" FROM days""",
    "stations": 'SELECT DISTINCT "stationID" FROM valid',
    "flow": """SELECT "stationID", "startTime", "startTime" + INTERVAL 10 MINUTE AS "endTime",
        coalesce("inNums", 0) AS "inNums", coalesce("outNums", 0) AS "outNums"
        FROM stations CROSS JOIN slots LEFT JOIN observed USING ("stationID", "startTime")""",
    "daily": """SELECT CAST("startTime" AS DATE) AS "date", CAST(sum("inNums") AS BIGINT) AS "inNums",
        CAST(sum("outNums") AS BIGINT) AS "outNums" FROM flow GROUP BY 1""",
    "station_daily": """SELECT "stationID", CAST("startTime" AS DATE) AS "date",
        CAST(sum("inNums") AS BIGINT) AS "inNums", CAST(sum("outNums") AS BIGINT) AS "outNums"
        FROM flow GROUP BY 1, 2""",
    "lines": f'SELECT * FROM (VALUES {_values(LINE_NAMES)}) AS t("lineID", "lineName")',
    "names": f'SELECT * FROM (VALUES {_values(STATION_NAMES)}) AS t("stationID", "stationName")',
    "chart_names": f'SELECT * FROM (VALUES {_values(TARGET_STATION_LABELS)}) AS t("stationID", "chartLabel")',
    "named": """SELECT s.*, "lineName", "stationName" FROM swipes s LEFT JOIN lines USING ("lineID")
        LEFT JOIN names USING ("stationID") WHERE status = 1""",
    "hour_counts": """SELECT "lineName", date_trunc('hour', "time") AS "time", count(*) AS "count"
        FROM named WHERE "lineName" IS NOT NULL GROUP BY 1, 2""",
    "hour_spine": """SELECT "lineName", unnest(generate_series(min("time"), max("time"), INTERVAL 1 HOUR)) AS "time"
        FROM hour_counts GROUP BY 1""",
    "hourly": """SELECT "lineName", "time", coalesce("count", 0) AS "count"
        FROM hour_spine LEFT JOIN hour_counts USING ("lineName", "time")""",
    "profile": """SELECT "lineName", "stationName", count(*) AS "count", min("stationID") AS first_id
        FROM named WHERE "lineName" IS NOT NULL AND "stationName" IS NOT NULL GROUP BY 1, 2""",
    "places": """SELECT "stationName", max("stationID") AS station_order FROM named
        WHERE "stationName" IS NOT NULL GROUP BY 1""",
    "features": f"""SELECT *, CAST("startTime" AS DATE) AS "date", CAST(hour("startTime") AS INTEGER) AS "hour",
        CAST(minute("startTime") AS INTEGER) AS "minute", CAST(isodow("startTime") - 1 AS INTEGER) AS weekday,
        CAST(isodow("startTime") >= 6 AS INTEGER) AS "isWeekend",
        {", ".join(f'CAST("stationID" = {s} AS INTEGER) AS station_{s}' for s in TARGET_STATIONS)} FROM flow""",
}

_CALENDAR = """CAST(isodow("date") - 1 AS INTEGER) AS "dayOfWeek", CAST(day("date") AS INTEGER) AS "dayOfMonth",
    CAST(isodow("date") >= 6 AS INTEGER) AS "isWeekend", CAST(week("date") AS INTEGER) AS week_number"""


def _with(steps: str, body: str, recursive: str = "") -> str:
    """A statement from named steps; a step may use the ones named before it."""
    parts = [f'"{name}" AS ({_STEPS[name]})' for name in steps.split()]
    keyword = "WITH RECURSIVE" if recursive else "WITH"
    if recursive:
        parts.append(recursive)
    return f"{keyword} {', '.join(parts)} {body}" if parts else body


_FLOW = "swipes valid observed days slots stations flow"
_DAILY = f"{_FLOW} daily"
_STATION_DAILY = f"{_FLOW} station_daily"
_NAMED = "swipes lines names named"
_HOURLY = f"{_NAMED} hour_counts hour_spine hourly"


def _daily_features_sql(steps: str, table: str, key: str = "", digits: int | None = 8) -> str:
    first = f"{key}, " if key else ""
    over = f'OVER ({f"PARTITION BY {key} " if key else ""}ORDER BY "date"'
    seven = f"{over} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"

    def mean(column: str) -> str:
        return f'avg("{column}") {seven}' if digits is None else f'round(avg("{column}") {seven}, {digits})'

    return _with(
        steps,
        f"""SELECT {first}"date", "inNums", "outNums", {_CALENDAR},
        coalesce(lag("inNums") {over}), "inNums") AS prev_day_in,
        coalesce(lag("outNums") {over}), "outNums") AS prev_day_out,
        {mean("inNums")} AS rolling_mean_in_7d, {mean("outNums")} AS rolling_mean_out_7d FROM {table}""",
    )


def _line_sql(line: dict[str, float], side: str) -> str:
    names = {
        f"prev_day_{side}": f"r.{side}_now",
        f"rolling_mean_{side}_7d": f"r.{side}_mean",
        "isWeekend": "CAST(isodow(r.next_day) >= 6 AS DOUBLE)",
        "dayOfWeek": "CAST(isodow(r.next_day) - 1 AS DOUBLE)",
    }
    terms = [f"CAST({line.get('', 0.0)!r} AS DOUBLE)"]
    terms += [f"CAST({v!r} AS DOUBLE) * {names[k]}" for k, v in line.items() if k]
    return f"CAST(CAST(round_even({' + '.join(terms)}, 0) AS DOUBLE) AS BIGINT)"


def _recursive_sql() -> str:
    chain = f"""tail AS (SELECT "stationID", max("date") AS last_day, max_by("inNums", "date") AS in_now,
            max_by("outNums", "date") AS out_now, avg("inNums") AS in_mean, avg("outNums") AS out_mean
            FROM (SELECT *, row_number() OVER (PARTITION BY "stationID" ORDER BY "date" DESC) AS rn
                  FROM station_daily) WHERE rn <= 7 GROUP BY 1),
        steps AS (SELECT "stationID", 0 AS step, CAST(last_day + 1 AS DATE) AS next_day, in_now, out_now,
                in_mean, out_mean FROM tail
            UNION ALL
            SELECT r."stationID", r.step + 1, CAST(r.next_day + 1 AS DATE), {_line_sql(ENTRY_LINE, "in")},
                {_line_sql(EXIT_LINE, "out")}, r.in_mean, r.out_mean
            FROM steps r WHERE r.step < {RECURSIVE_DAYS})"""
    body = """SELECT "stationID", CAST(next_day - 1 AS DATE) AS "date",
        CAST(isodow(CAST(next_day - 1 AS DATE)) - 1 AS INTEGER) AS "dayOfWeek",
        in_now AS "inNums", out_now AS "outNums", TRUE AS "isPrediction" FROM steps WHERE step > 0"""
    return _with(_STATION_DAILY, body, chain)


def _report_sql(extra: str = "") -> str:
    label = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(WEEKDAY_LABELS, 1))
    names = [f'"{name}"' for name in REPORT_COLUMNS]
    mean = "CAST(CAST(round_even(avg(\"{0}\"), 0) AS DOUBLE) AS BIGINT) AS \"{0}\""
    return _with(
        _DAILY,
        f"""SELECT strftime("date", '%Y-%m-%d') AS {names[0]}, CASE isodow("date") {label} END AS {names[1]},
        format('{{:,}}', "inNums") AS {names[2]}, format('{{:,}}', "outNums") AS {names[3]},
        kind AS {names[4]}{extra} FROM (
            SELECT *, '{ACTUAL_LABEL}' AS kind FROM daily
            UNION ALL
            SELECT CAST(last_day + i AS DATE), "inNums", "outNums", '{FORECAST_LABEL}' FROM (
                SELECT max("date") AS last_day, {mean.format("inNums")}, {mean.format("outNums")}
                FROM (SELECT * FROM daily ORDER BY "date" DESC LIMIT 7))
            CROSS JOIN (SELECT unnest(range(1, {RECURSIVE_DAYS + 1}))::INTEGER AS i))""",
    )


def _slot_lines_sql() -> str:
    def line(target: str) -> str:
        weekday, weekend = SLOT_LINES["weekday", target], SLOT_LINES["weekend", target]
        value = f"CASE WHEN weekday < 5 THEN {weekday} ELSE {weekend} END"
        return f'greatest(CAST(round_even(CAST({value} AS DOUBLE), 0) AS BIGINT), 0) AS "{target}"'

    return _with(
        "swipes valid days stations",
        f"""SELECT "stationID", "startTime", "startTime" + INTERVAL 10 MINUTE AS "endTime", {line("inNums")}, {line("outNums")}
        FROM (SELECT "stationID", "startTime", hour("startTime") AS "hour", minute("startTime") AS "minute",
            isodow("startTime") - 1 AS weekday, CAST("stationID" = 10 AS INTEGER) AS station_10
            FROM stations CROSS JOIN (SELECT unnest(generate_series(first, first + INTERVAL {HORIZON_DAYS * 1440 - 10} MINUTE,
            INTERVAL 10 MINUTE)) AS "startTime" FROM (SELECT max("day") + INTERVAL 1 DAY AS first FROM days)))""",
    )


def _baseline_sql(body: str) -> str:
    def scores(model: str, place: int, key: str) -> str:
        same = f'AND b."{key}" = a."{key}"' if key else ""
        return f"""SELECT 'inNums' AS target, '{model}' AS model, {place} AS place, fold, avg((y - p) * (y - p)) AS mse, var_pop(y) AS v
            FROM (SELECT fold, CAST("inNums" AS DOUBLE) AS y, (SELECT avg(b."inNums") FROM folded b WHERE b.fold <> a.fold {same}) AS p
            FROM folded a) GROUP BY fold"""

    steps = f"""folded AS MATERIALIZED (SELECT s.*, fold FROM station_daily s JOIN (SELECT "date", ntile(5) OVER (ORDER BY "date") - 1 AS fold
            FROM (SELECT DISTINCT "date" FROM station_daily)) USING ("date")),
        scores AS ({scores("overall_mean", 0, "")} UNION ALL {scores("station_mean", 1, "stationID")}),
        rated AS (SELECT *, sqrt(mse) AS rmse, CASE WHEN v > 0 THEN 1 - mse / v WHEN mse = 0 THEN 1 ELSE 0 END AS r2 FROM scores),
        summary AS (SELECT target, model, CAST(place AS INTEGER) AS place, round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std,
            round(avg(rmse), 6) AS rmse_mean, round(stddev_pop(rmse), 6) AS rmse_std FROM rated GROUP BY 1, 2, 3)"""
    return _with(_STATION_DAILY, f", {steps} {body}")


def _linear_cv_sql(ridge: float = CV_RIDGE) -> str:
    """Sums over the other folds, elimination without pivots on scaled features, residuals of the fold's own rows."""
    names, p = [f'"{c}"' for c in DAILY_FEATURES], len(DAILY_FEATURES)

    def cell(i: int, j: int) -> str:
        return f"covar_pop({names[i]}, {names[j]}) / (d[{i + 1}] * d[{j + 1}]) + {ridge if i == j else 0.0!r}"

    def system(target: str) -> str:
        rows = [
            f"""[{", ".join(cell(i, j) for j in range(p))}, covar_pop({names[i]}, "{target}") / d[{i + 1}]]""" for i in range(p)
        ]
        return f"""SELECT '{target}' AS target, out, m, d, avg("{target}") AS y, [{", ".join(rows)}] AS a
            FROM sides GROUP BY out, m, d"""

    steps = f"""seen AS MATERIALIZED ({_daily_features_sql(_STATION_DAILY, "station_daily", '"stationID"', None)}),
        folded AS MATERIALIZED (SELECT s.*, fold FROM seen s JOIN (SELECT "date", CAST(ntile(5) OVER (ORDER BY "date") - 1 AS INTEGER) AS fold
            FROM (SELECT DISTINCT "date" FROM seen)) USING ("date")),
        scales AS (SELECT f.out, [{", ".join(f"avg({c})" for c in names)}] AS m,
            [{", ".join(f"CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END" for c in names)}] AS d
            FROM folded JOIN (SELECT DISTINCT fold AS out FROM folded) f ON fold <> out GROUP BY f.out),
        sides AS (SELECT folded.*, scales.* FROM folded JOIN scales ON fold <> out),
        systems AS ({" UNION ALL ".join(system(t) for t in TARGETS)}),
        solved AS (SELECT target, out, m, d, y, a, 0 AS k FROM systems UNION ALL
            SELECT target, out, m, d, y, list_transform(a, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: v / a[k + 1][k + 1])
                ELSE list_transform(r, lambda v, j: v - r[k + 1] * a[k + 1][j] / a[k + 1][k + 1]) END), k + 1 FROM solved WHERE k < {p}),
        guessed AS (SELECT target, fold, CASE target WHEN 'inNums' THEN "inNums" ELSE "outNums" END AS t,
            y + {" + ".join(f"a[{i + 1}][{p + 1}] * ({c} - m[{i + 1}]) / d[{i + 1}]" for i, c in enumerate(names))} AS guess
            FROM folded JOIN solved ON fold = out AND k = {p})"""
    body = """SELECT target, fold, count(*) AS n, round(avg((t - guess) * (t - guess)), 6) AS mse, round(sqrt(avg((t - guess) * (t - guess))), 6) AS rmse,
        round(CASE WHEN var_pop(t) > 0 THEN 1 - avg((t - guess) * (t - guess)) / var_pop(t)
            WHEN avg((t - guess) * (t - guess)) = 0 THEN 1 ELSE 0 END, 6) AS r2 FROM guessed GROUP BY target, fold"""
    return f"WITH RECURSIVE {steps} {body}"


def _kernel_waves_sql() -> str:
    weights, phases = kernel_draws(len(DAILY_FEATURES), 1.0 / len(DAILY_FEATURES), KERNEL_WAVES)
    stats = ", ".join(f'avg("{c}") AS "{c}_m", stddev_pop("{c}") AS "{c}_s"' for c in DAILY_FEATURES)
    scaled = ", ".join(f'("{c}" - "{c}_m") / CASE WHEN "{c}_s" > 0 THEN "{c}_s" ELSE 1 END' for c in DAILY_FEATURES)
    draws = ", ".join(f"({i}, {row.tolist()!r}::DOUBLE[], {float(phase)!r}::DOUBLE)" for i, (row, phase) in enumerate(zip(weights, phases, strict=True)))
    return f"""WITH seen AS MATERIALIZED ({_daily_features_sql(_STATION_DAILY, "station_daily", '"stationID"', None)}),
        scaled AS (SELECT "stationID", "date", [{scaled}]::DOUBLE[] AS z FROM seen CROSS JOIN (SELECT {stats} FROM seen)),
        draws AS (SELECT * FROM (VALUES {draws}) AS t(wave, w, phase))
        SELECT "stationID", "date", CAST(wave AS INTEGER) AS wave,
        round(sqrt(2.0::DOUBLE / {KERNEL_WAVES}) * cos(list_inner_product(z, w) + phase), 8) AS "value" FROM scaled CROSS JOIN draws"""


def _spline_sql(n: int = 300) -> str:
    """The not-a-knot spline through hourly points: forward elimination and back substitution, a row a step."""
    chain = f"""points AS MATERIALIZED (SELECT "lineName", "time", avg("count") OVER (PARTITION BY "lineName" ORDER BY "time"
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS y, row_number() OVER (PARTITION BY "lineName" ORDER BY "time") - 1 AS i,
            count(*) OVER (PARTITION BY "lineName") AS n FROM hourly),
        knots AS MATERIALIZED (SELECT *, 6 * (lead(y) OVER w - 2 * y + lag(y) OVER w) AS r FROM points
            WINDOW w AS (PARTITION BY "lineName" ORDER BY i)),
        down("lineName", i, n, d, r) AS (SELECT "lineName", i, n, CAST(6 AS DOUBLE), r FROM knots WHERE i = 1
            UNION ALL SELECT k."lineName", k.i, k.n, CASE WHEN k.i = k.n - 2 THEN 6 ELSE 4 - CASE WHEN k.i = 2 THEN 0 ELSE 1 END / p.d END,
                CASE WHEN k.i = k.n - 2 THEN k.r ELSE k.r - p.r / p.d END
            FROM down p JOIN knots k ON k."lineName" = p."lineName" AND k.i = p.i + 1 WHERE k.i <= k.n - 2),
        up("lineName", i, m) AS (SELECT "lineName", i, r / d FROM down WHERE i = n - 2
            UNION ALL SELECT q."lineName", q.i, (q.r - CASE WHEN q.i = 1 THEN 0 ELSE u.m END) / q.d
            FROM up u JOIN down q ON q."lineName" = u."lineName" AND q.i = u.i - 1),
        bends AS MATERIALIZED (SELECT "lineName", i, m FROM up
            UNION ALL SELECT a."lineName", 0, 2 * a.m - b.m FROM up a JOIN up b ON a."lineName" = b."lineName" AND a.i = 1 AND b.i = 2
            UNION ALL SELECT a."lineName", n - 1, 2 * a.m - b.m FROM up a JOIN (SELECT DISTINCT "lineName", n FROM points) USING ("lineName")
                JOIN up b ON a."lineName" = b."lineName" AND a.i = n - 2 AND b.i = n - 3),
        grid AS (SELECT "lineName", min("time") AS first, max(n) AS n, unnest(generate_series(0, {n - 1})) AS step FROM points GROUP BY 1),
        spots AS (SELECT *, step * ((n - 1) / CAST({n - 1} AS DOUBLE)) AS x FROM grid),
        cells AS (SELECT *, least(CAST(floor(x) AS BIGINT), n - 2) AS k FROM spots)"""
    body = """SELECT c."lineName", c.first + to_microseconds(CAST(round(x * 3.6e9) AS BIGINT)) AS "time", round(
        (k + 1 - x) * p.y + (x - k) * q.y + (((k + 1 - x) ** 3 - (k + 1 - x)) * a.m + ((x - k) ** 3 - (x - k)) * b.m) / 6, 6) AS count_smoothed
        FROM cells c JOIN points p ON p."lineName" = c."lineName" AND p.i = k JOIN points q ON q."lineName" = c."lineName" AND q.i = k + 1
        JOIN bends a ON a."lineName" = c."lineName" AND a.i = k JOIN bends b ON b."lineName" = c."lineName" AND b.i = k + 1"""
    return _with(_HOURLY, body, chain)


def _title_sql(first: str, last: str) -> str:
    return f"""CASE WHEN {first} = {last} THEN strftime({first}, '%Y-%m-%d') || ' (' || dayname({first}) || ')'
        ELSE '{MANY_DAYS_LABEL}' END AS title_date"""


def _describe_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count("{column}") AS "count", round(avg("{column}"), 8) AS "mean",
        round(stddev_samp("{column}"), 8) AS "std", min("{column}") AS "min",
        quantile_cont("{column}", 0.25) AS p25, quantile_cont("{column}", 0.5) AS p50,
        quantile_cont("{column}", 0.75) AS p75, max("{column}") AS "max" FROM flow"""


def _scaled_sql() -> str:
    columns = ["hour", "minute", "weekday", "station_10", "inNums"]
    stats = ", ".join(f'avg("{c}") AS "{c}_m", stddev_pop("{c}") AS "{c}_s"' for c in columns)
    scaled = ", ".join(
        f'floor(("{c}" - "{c}_m") / CASE WHEN "{c}_s" > 0 THEN "{c}_s" ELSE 1 END * 1e6 + 0.5) / 1e6 AS "{c}_z"'
        for c in columns
    )
    body = f""", kept AS MATERIALIZED (SELECT * FROM features)
        SELECT "stationID", "startTime", {scaled} FROM kept CROSS JOIN (SELECT {stats} FROM kept)"""
    return _with(f"{_FLOW} features", body)


def flow_oracles() -> dict[str, str]:
    """DuckDB statements. Left out: what is fitted."""
    raw = 'SELECT "time", "lineID", CAST("stationID" AS INTEGER) AS "stationID", status'
    ids = ", ".join(str(s) for s in TARGET_STATIONS)
    audit_nulls = ", ".join(
        f'count(*) FILTER ("{c}" IS NULL) AS "null_{c}"' for c in ("time", "lineID", "stationID", "status")
    )
    any_null = '("time" IS NULL OR "lineID" IS NULL OR "stationID" IS NULL OR status IS NULL)'
    each_null = " + ".join(f'CAST("{c}" IS NULL AS BIGINT)' for c in ("time", "lineID", "stationID", "status"))
    trends = " UNION ALL ".join(
        f"""SELECT '{t}' AS target, '{f}' AS feature, round(regr_slope("{t}", "{f}"), 8) AS slope,
        round(regr_intercept("{t}", "{f}"), 8) AS intercept FROM features"""
        for t in TARGETS
        for f in ("hour", "minute", "weekday")
    )
    dated_flow = 'SELECT *, CAST("startTime" AS DATE) AS "date" FROM flow'
    statements = {
        "swipes_csv_roundtrip": _with("swipes", f"{raw} FROM swipes"),
        "read_days_roundtrip": _with("swipes", f'{raw}, CAST("time" AS DATE) AS "date" FROM swipes'),
        "flow_parquet_roundtrip": _with(_FLOW, dated_flow),
        "forecast_csv_roundtrip": _with(
            _FLOW,
            """SELECT "stationID", strftime("startTime", '%Y-%m-%d %H:%M:%S') AS "startTime",
            strftime("endTime", '%Y-%m-%d %H:%M:%S') AS "endTime", "inNums", "outNums" FROM flow""",
        ),
        "report_csv_roundtrip": _report_sql(', "inNums", "outNums"'),
        "chart_feed": _with(
            f"{_NAMED} profile places",
            """SELECT "lineName", "stationName", "count", station_order
            FROM profile LEFT JOIN places USING ("stationName")""",
        ),
        "clean_swipes": _with("dirty", f"SELECT DISTINCT * FROM dirty WHERE NOT {any_null}"),
        "quality_audit": _with(
            "dirty",
            f"""SELECT (SELECT count(*) FROM dirty) AS "rows",
            (SELECT count(*) FROM dirty) - count(*) AS duplicate_rows,
            CAST(sum({each_null}) AS BIGINT) AS null_cells, count(*) FILTER ({any_null}) AS incomplete_rows,
            count(*) FILTER (NOT {any_null}) AS clean_rows, {audit_nulls} FROM (SELECT DISTINCT * FROM dirty)""",
        ),
        "valid_swipes": _with("swipes valid", "SELECT * FROM valid"),
        "boardings": _with("swipes", "SELECT * FROM swipes WHERE status = 1"),
        "station_names": _with(
            "swipes names chart_names",
            f"""SELECT event_id, "stationID", "stationName",
            coalesce("stationName", '{STATION_PREFIX}' || "stationID") AS "stationLabel", "chartLabel"
            FROM swipes LEFT JOIN names USING ("stationID") LEFT JOIN chart_names USING ("stationID")""",
        ),
        "line_names": _with(
            "swipes lines", 'SELECT event_id, "lineID", "lineName" FROM swipes LEFT JOIN lines USING ("lineID")'
        ),
        "unmapped_stations": _with(_NAMED, 'SELECT DISTINCT "stationID" FROM named WHERE "stationName" IS NULL'),
        "unmapped_lines": _with(_NAMED, 'SELECT DISTINCT "lineID" FROM named WHERE "lineName" IS NULL'),
        "missing_days": _with(
            "swipes",
            """SELECT "stationID", "date" FROM (SELECT DISTINCT "stationID" FROM swipes) CROSS JOIN (
                SELECT CAST(unnest(generate_series(CAST(min("time") AS DATE), CAST(max("time") AS DATE),
                INTERVAL 1 DAY)) AS DATE) AS "date" FROM swipes)
            EXCEPT SELECT "stationID", CAST("time" AS DATE) FROM swipes""",
        ),
        "first_rows": _with("swipes", 'SELECT * FROM swipes ORDER BY "time", event_id LIMIT 5'),
        "station_flow": _with(_FLOW, "SELECT * FROM flow"),
        "observed_flow": _with("swipes valid observed", "SELECT * FROM observed"),
        "merge_directions": _with("swipes valid observed", "SELECT * FROM observed"),
        "flow_group_bounds": _with(
            "swipes valid observed",
            """SELECT "stationID", "startTime", "startTime" + INTERVAL 10 MINUTE AS "endTime",
            coalesce("inNums", 0) AS "inNums", coalesce("outNums", 0) AS "outNums" FROM (
                SELECT "stationID", unnest(generate_series(min("startTime"), max("startTime"), INTERVAL 10 MINUTE))
                AS "startTime" FROM observed GROUP BY 1)
            LEFT JOIN observed USING ("stationID", "startTime")""",
        ),
        "calendar_spine": _with(
            "swipes valid days stations",
            """SELECT "stationID", unnest(generate_series("day", "day" + INTERVAL 23 HOUR, INTERVAL 1 HOUR))
            AS "startTime" FROM stations CROSS JOIN days""",
        ),
        "target_stations": _with(_FLOW, f'SELECT * FROM flow WHERE "stationID" IN ({ids})'),
        "named_station_flow": _with(
            f"{_FLOW} names", 'SELECT * FROM flow WHERE "stationID" IN (SELECT "stationID" FROM names)'
        ),
        "day_slice": _with(
            _FLOW, """SELECT * FROM flow WHERE "stationID" = 10 AND CAST("startTime" AS DATE) = DATE '2024-01-15'"""
        ),
        "weekday_rows": _with(_FLOW, f'SELECT * FROM ({dated_flow}) WHERE isodow("date") < 6'),
        "weekend_rows": _with(_FLOW, f'SELECT * FROM ({dated_flow}) WHERE isodow("date") >= 6'),
        "describe_flow": _with(_FLOW, f"{_describe_sql('inNums')} UNION ALL {_describe_sql('outNums')}"),
        "line_station_profile": _with(
            f"{_NAMED} profile places",
            """SELECT "lineName", "stationName", "count", station_order
            FROM profile LEFT JOIN places USING ("stationName")""",
        ),
        "line_station_profile_by_id": _with(
            f"{_NAMED} profile", 'SELECT "lineName", "stationName", "count", first_id AS station_order FROM profile'
        ),
        "line_hourly": _with(_HOURLY, "SELECT * FROM hourly"),
        "line_hourly_smoothed": _with(
            _HOURLY,
            """SELECT *, round(avg("count") OVER (PARTITION BY "lineName" ORDER BY "time"
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 8) AS count_smoothed FROM hourly""",
        ),
        "line_time_grid": _with(
            _HOURLY,
            """SELECT "lineName", point, make_timestamp(epoch_us(lo)
            + CAST(round((epoch_us(hi) - epoch_us(lo)) * point / 299.0) AS BIGINT)) AS "time" FROM (
                SELECT "lineName", min("time") AS lo, max("time") AS hi,
                CAST(unnest(range(0, 300)) AS INTEGER) AS point FROM hourly GROUP BY 1)""",
        ),
        "date_label": _with(
            _HOURLY,
            f"""SELECT {_title_sql("a", "z")} FROM (
            SELECT CAST(min("time") AS DATE) AS a, CAST(max("time") AS DATE) AS z FROM hourly)""",
        ),
        "date_label_by_day": _with(
            "swipes",
            f"""SELECT "date", {_title_sql("a", "z")} FROM (SELECT CAST("time" AS DATE) AS "date",
            CAST(min("time") AS DATE) AS a, CAST(max("time") AS DATE) AS z
            FROM swipes WHERE status = 1 GROUP BY 1)""",
        ),
        "daily_totals": _with(_DAILY, "SELECT * FROM daily"),
        "daily_flow": _with(_DAILY, "SELECT * FROM daily"),
        "station_daily_flow": _with(_STATION_DAILY, "SELECT * FROM station_daily"),
        "daily_features": _daily_features_sql(_DAILY, "daily"),
        "station_daily_features": _daily_features_sql(_STATION_DAILY, "station_daily", '"stationID"'),
        "last_days": _with(
            _STATION_DAILY,
            """SELECT "stationID", "date", "inNums", "outNums" FROM (SELECT *, row_number() OVER (
            PARTITION BY "stationID" ORDER BY "date" DESC) AS rn FROM station_daily) WHERE rn <= 7""",
        ),
        "last_day": _with(
            _STATION_DAILY,
            """SELECT "stationID", max("date") AS "date", max_by("inNums", "date") AS "inNums",
            max_by("outNums", "date") AS "outNums" FROM station_daily GROUP BY 1""",
        ),
        "tail_mean": _with(
            _STATION_DAILY,
            """SELECT "stationID", round(avg("inNums"), 8) AS "inNums", round(avg("outNums"), 8) AS "outNums"
            FROM (SELECT *, row_number() OVER (PARTITION BY "stationID" ORDER BY "date" DESC) AS rn
            FROM station_daily) WHERE rn <= 7 GROUP BY 1""",
        ),
        "slot_features": _with(f"{_FLOW} features", 'SELECT * EXCLUDE ("endTime") FROM features'),
        "aligned_features": _with(
            f"{_FLOW} features",
            """SELECT "startTime", "stationID", "hour", "minute", weekday, station_10,
            CAST(0 AS INTEGER) AS station_absent FROM features""",
        ),
        "scaled_features": _scaled_sql(),
        "split_exact": _with(
            _FLOW,
            """SELECT "stationID", "startTime", "inNums", "outNums", row_number() OVER (ORDER BY
            md5(concat_ws('|', CAST("stationID" AS VARCHAR), strftime("startTime", '%Y-%m-%d %H:%M:%S'), '42')),
            "stationID", "startTime") <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test FROM flow""",
        ),
        "folds": _with(_DAILY, 'SELECT *, CAST(ntile(5) OVER (ORDER BY "date") - 1 AS INTEGER) AS fold FROM daily'),
        "regression_metrics": _with(
            _FLOW,
            """SELECT "stationID", count(*) AS n, round(avg((y - p) * (y - p)), 8) AS mse,
            round(sqrt(avg((y - p) * (y - p))), 8) AS rmse, round(CASE
                WHEN var_pop(y) > 0 THEN 1 - avg((y - p) * (y - p)) / var_pop(y)
                WHEN avg((y - p) * (y - p)) = 0 THEN 1 ELSE 0 END, 8) AS r2
            FROM (SELECT "stationID", CAST("inNums" AS DOUBLE) AS y,
                avg("inNums") OVER (PARTITION BY "stationID") AS p FROM flow) GROUP BY 1""",
        ),
        "observed_in_order": _with(
            "swipes valid observed",
            """SELECT "stationID", "startTime", "inNums", "outNums",
            row_number() OVER (ORDER BY "stationID", "startTime") AS place FROM observed""",
        ),
        "profile_in_order": _with(
            f"{_NAMED} profile places",
            """SELECT "lineName", "stationName", "count", station_order,
            row_number() OVER (ORDER BY "lineName", station_order, "stationName") AS place
            FROM profile LEFT JOIN places USING ("stationName")""",
        ),
        "linear_trend": _with(f"{_FLOW} features", trends),
        "linear_cv": _linear_cv_sql(),
        "kernel_waves": _kernel_waves_sql(),
        "forecast_grid": _with(
            "swipes valid days stations",
            f"""SELECT "stationID", "startTime", "startTime" + INTERVAL 10 MINUTE AS "endTime" FROM stations CROSS JOIN (
            SELECT unnest(generate_series(first, first + INTERVAL {HORIZON_DAYS * 1440 - 10} MINUTE,
            INTERVAL 10 MINUTE)) AS "startTime" FROM (SELECT max("day") + INTERVAL 1 DAY AS first FROM days))""",
        ),
        "recursive_linear": _recursive_sql(),
        "report": _report_sql(),
        "flow_stream": _with(
            "swipes valid observed",
            """SELECT "stationID", "startTime", "startTime" + INTERVAL 10 MINUTE AS "endTime", "inNums", "outNums"
            FROM observed""",
        ),
        "rollup_by_days": _with(
            _FLOW,
            """SELECT "stationID", CAST("startTime" AS DATE) AS "date", count(*) AS slots, CAST(sum("inNums") AS BIGINT) AS "inNums",
            CAST(sum("outNums") AS BIGINT) AS "outNums" FROM flow GROUP BY 1, 2""",
        ),
        "read_days_mixed": _with("swipes", f'{raw}, CAST("time" AS DATE) AS "date" FROM swipes'),
        "flow_csv_roundtrip": _with(_FLOW, 'SELECT *, CAST("startTime" AS DATE) AS "date" FROM flow'),
        "rollup_audit": _with(
            "dirty",
            """SELECT count(*) AS "rows", count(*) FILTER (status IN (0, 1) AND "stationID" IS NOT NULL) AS counted,
            count(*) FILTER (status NOT IN (0, 1)) AS other_status,
            count(*) FILTER (status IN (0, 1) AND "stationID" IS NULL) AS no_station, CAST(0 AS BIGINT) AS no_time FROM dirty""",
        ),
        "parsed_times": """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN date_trunc('second', ts) END AS "time" FROM events""",
        "slot_labels": """SELECT strftime(time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '2000-01-01'), '%H:%M') AS slot,
            count(*) AS n FROM events GROUP BY 1""",
        "split_hash": _with(
            _FLOW,
            f"""SELECT is_test, count(*) AS n, CAST(sum("inNums") AS BIGINT) AS "inNums" FROM (SELECT *, substr(md5(concat_ws('|',
            CAST("stationID" AS VARCHAR), strftime("startTime", '%Y-%m-%d %H:%M:%S'), '42')), 1, 8) < '{round(0.2 * 2**32):08x}'
            AS is_test FROM flow) GROUP BY 1""",
        ),
        "forecast_slots_linear": _slot_lines_sql(),
        "baseline_leaderboard": _baseline_sql("SELECT * FROM summary"),
        "baseline_winner": _baseline_sql(
            "SELECT target, arg_max(model, (r2_mean, -place)) AS model, max(r2_mean) AS r2_mean FROM summary GROUP BY 1"
        ),
        "line_hourly_spline": _spline_sql(),
    }
    dated = """read_days_roundtrip flow_parquet_roundtrip missing_days weekday_rows weekend_rows date_label_by_day
        daily_totals daily_flow station_daily_flow daily_features station_daily_features last_days last_day
        slot_features folds kernel_waves rollup_by_days recursive_linear read_days_mixed flow_csv_roundtrip""".split()
    for name in dated:
        statements[name] = f'SELECT * REPLACE (CAST("date" AS VARCHAR) AS "date") FROM ({statements[name]})'
    return statements
