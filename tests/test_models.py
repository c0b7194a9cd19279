import math


import numpy as np
import pytest
from conftest import at, day, rows_of
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from flowgauge.models.competition import (
    fit_daily_models,
    fit_slot_models,
    load_daily_models,
    load_slot_models,
    predict,
    save_models,
)
from flowgauge.models.estimators import KernelRegression, PopulationScaler, fit_labels, linear, random_forest
from flowgauge.models.forecast import forecast_recursive, forecast_slots, linear_predictor, model_predictor
from flowgauge.models.normal_equations import Moments, linear_cv, linear_folds
from flowgauge.operators.features import DAILY_FEATURES, daily_features
from flowgauge.operators.stats import regression_metrics
from flowgauge.plans.report import build_report
from flowgauge.session import scratch_path

# Daily totals of 25 days (date, entries, exits): fixed values.
ACTUAL_DAYS = """
2019-01-01 1270547 1269045
2019-01-02 1187799 1188663
2019-01-03 1146469 1147002
2019-01-04 1211535 1212307
2019-01-05 1006887 1011043
2019-01-06 973818 974441
2019-01-07 1128213 1129221
2019-01-08 1151957 1152871
2019-01-09 1140025 1141438
2019-01-10 1157908 1159623
2019-01-11 1249994 1251866
2019-01-12 1083797 1084767
2019-01-13 1031230 1032358
2019-01-14 1197939 1199228
2019-01-15 1153423 1152828
2019-01-16 1207951 1209108
2019-01-17 1236936 1237837
2019-01-18 1331633 1332770
2019-01-19 1104492 1104846
2019-01-20 1056816 1056825
2019-01-21 1232911 1233048
2019-01-22 1237937 1238371
2019-01-23 1261750 1262212
2019-01-24 1258873 1258497
2019-01-25 1288580 1287602
"""


@pytest.fixture(scope="module")
def daily(spark):
    rows = [line.split() for line in ACTUAL_DAYS.split("\n") if line]
    return spark.createDataFrame([(day(d), int(i), int(o)) for d, i, o in rows], "date date, inNums long, outNums long")


@pytest.fixture(scope="module")
def wave(spark):
    return spark.range(600).select(
        (F.col("id") / 100).alias("x"), F.lit(1).alias("flat"), F.sin(F.col("id") / 100).alias("y")
    )


def r2(df, label="y"):
    return regression_metrics(df, label, "prediction").first()["r2"]


def test_linear_recovers_a_line(spark):
    df = spark.range(50).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    df = df.withColumn("y", 3 * F.col("a") - 2 * F.col("b") + 5)
    assert r2(predict(df, linear(["a", "b"], "y").fit(df))) == pytest.approx(1)


def test_linear_of_dependent_columns_is_the_exact_solution(spark, daily):
    """Recursive days of the line of least weights, solved outside of Spark on scaled features."""
    table = daily_features(daily)
    rows = table.orderBy("date").collect()
    predictions = {}
    for target in ("inNums", "outNums"):
        model = linear(DAILY_FEATURES, target).fit(table)
        x = np.array([[float(r[c]) for c in DAILY_FEATURES] for r in rows])
        mean, std = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1)
        z, y = (x - mean) / std, np.array([float(r[target]) for r in rows])
        assert np.linalg.matrix_rank(z) < len(DAILY_FEATURES)
        weights = np.linalg.lstsq(z, y - y.mean(), rcond=1e-9)[0]
        exact = z @ weights + y.mean()
        got = [r["prediction"] for r in predict(table, model).orderBy("date").collect()]
        assert got == pytest.approx(exact.tolist(), abs=0.5)
        predictions[target] = model
    first = forecast_recursive(daily, model_predictor(predictions), 6).orderBy("date").first()
    assert (first["inNums"], first["outNums"]) == (1_128_473, 1_127_295)


def plain_folds(table, target, folds=5):
    """(fold, n, mse, r2) of least squares lines of least weights on scaled features, each fold left out in turn."""
    rows = table.orderBy("date").collect()
    x = np.array([[float(r[c]) for c in DAILY_FEATURES] for r in rows])
    y = np.array([float(r[target]) for r in rows])
    dates = sorted({r["date"] for r in rows})
    fold_of = {d: f for f, block in enumerate(np.array_split(dates, folds)) for d in block}
    fold = np.array([fold_of[r["date"]] for r in rows])
    for f in range(folds):
        a, b = x[fold != f], x[fold == f]
        mean, std = a.mean(0), np.where(a.std(0) > 0, a.std(0), 1)
        weights = np.linalg.lstsq((a - mean) / std, y[fold != f] - y[fold != f].mean(), rcond=1e-7)[0]
        wrong = y[fold == f] - (b - mean) / std @ weights - y[fold != f].mean()
        yield f, len(b), (wrong**2).mean(), 1 - (wrong**2).mean() / y[fold == f].var()


def test_linear_folds_equal_exact_solutions(daily):
    """All folds of the 25 days, whose calendar features depend on each other, from one aggregation."""
    table = daily_features(daily)
    for target in ("inNums", "outNums"):
        got = [r for r in linear_cv(table, DAILY_FEATURES, ["inNums", "outNums"]).collect() if r["target"] == target]
        want = list(plain_folds(table, target))
        assert [(r["fold"], r["n"]) for r in got] == [w[:2] for w in want]
        assert [r["mse"] for r in got] == pytest.approx([w[2] for w in want], rel=1e-4)
        assert [r["r2"] for r in got] == pytest.approx([w[3] for w in want], rel=1e-4)


def test_linear_folds_run_one_job_and_give_the_line_of_all_rows(spark, daily):
    path = scratch_path(spark, "features")
    daily_features(daily).write.parquet(path)
    table = spark.read.parquet(path)
    spark.sparkContext.setJobGroup("folds", "")
    lines, scores = linear_folds(table, DAILY_FEATURES, ["inNums"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("folds")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2 and len(scores) == 5  # the two stages of one aggregation may be jobs
    predicted = predict(table, linear(DAILY_FEATURES, "inNums").fit(table)).select("date", "prediction").collect()
    ours = {r["date"]: r["_in"] for r in linear_predictor(lines["inNums"].coefficients(), {})(table).collect()}
    assert ours == pytest.approx({r["date"]: r["prediction"] for r in predicted}, rel=1e-5)


def test_moments_add_up_where_means_are_large():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) + 1e9

    def of(rows):
        return Moments(("a", "b", "c"), len(rows), rows.mean(0), (rows - rows.mean(0)).T @ (rows - rows.mean(0)))

    both, whole = of(x[:130]) + of(x[130:131]) + of(x[131:]), of(x)
    assert both.n == 400 and np.allclose(both.products, whole.products, rtol=1e-6)
    empty = Moments(("a", "b", "c"), 0, np.zeros(0), np.zeros(0))
    assert (empty + whole) is whole and (whole + empty) is whole


def test_linear_folds_with_nulls_constants_and_few_days(spark, daily):
    rows = [(day(f"2024-01-0{d}"), float(v), 7.0, None if d == 3 else float(2 * v + 1)) for d, v in ((1, 4), (2, 6), (3, 9), (4, 11))]
    table = spark.createDataFrame(rows, "date date, a double, flat double, y double")
    got = linear_cv(table, ["a", "flat"], ["y"]).collect()
    assert [(r["fold"], r["n"]) for r in got] == [(0, 1), (1, 1), (2, 1)] and all(r["rmse"] < 1e-4 for r in got)
    assert linear_cv(table.where("a > 10"), ["a"], ["y"]).count() == 0  # no other fold to learn from
    assert linear_cv(table.where("a > 99"), ["a"], ["y"]).count() == 0


def test_kernel_regression_beats_the_line_on_a_wave(wave):
    curve = r2(predict(wave, KernelRegression(["x", "flat"], "y").fit(wave)))
    assert curve > 0.99 > r2(predict(wave, linear(["x", "flat"], "y").fit(wave)))


def test_huber_loss_shrugs_off_outliers(wave):
    spoiled = wave.withColumn("z", F.when(F.col("x") == 3, 500.0).otherwise(F.col("y")))
    errors = {}
    for loss in ("squared", "huber"):
        model = KernelRegression(["x", "flat"], "z", size=32, loss=loss).fit(spoiled)
        errors[loss] = regression_metrics(predict(wave.withColumn("z", F.col("y")), model), "y", "prediction").first()["mse"]
    assert errors["huber"] < errors["squared"] / 10
    with pytest.raises(ValueError):
        KernelRegression(["x"], "y", loss="other")


def objective(model, df, label, c, epsilon, weights):
    """The support vector objective of a fitted pipeline, row by row."""
    rows = model.transform(df).select(label, "prediction").collect()
    return weights @ weights / 2 + c * sum(max(0.0, abs(r[label] - r["prediction"]) - epsilon) for r in rows)


@pytest.mark.parametrize("scale, c, epsilon", [(1.0, 1.0, 0.1), (1.0, 20.0, 0.01), (1e5, 1.0, 0.1), (1.0, 1.0, 5.0)])
def test_epsilon_loss_closes_the_duality_gap(wave, scale, c, epsilon):
    noisy = wave.withColumn("z", F.col("y") * scale + F.when(F.col("x") % 0.5 == 0, 3 * scale).otherwise(0.0))
    estimator = KernelRegression(["x", "flat"], "z", size=32, loss="epsilon", c=c, epsilon=epsilon)
    model = estimator.fit(noisy.repartition(5))
    fit = estimator.fit_
    assert fit.gap <= 1e-3 * max(fit.objective, 1e-9)
    assert objective(model, noisy, "z", c, epsilon, fit.weights) == pytest.approx(fit.objective, rel=1e-6, abs=1e-9)
    again = KernelRegression(["x", "flat"], "z", size=32, loss="epsilon", c=c, epsilon=epsilon)
    again.fit(noisy.repartition(2))
    assert again.fit_.objective == pytest.approx(fit.objective, rel=1e-3, abs=1e-9)
    # No small step from the solution is better.
    rng = np.random.default_rng(2)
    waves = model.transform(noisy).select("waves", "z").collect()
    z, y = np.array([r["waves"] for r in waves]), np.array([r["z"] for r in waves])
    for size in (1e-3, 1e-1, 1.0):
        w = fit.weights + size * rng.normal(size=32)
        other = w @ w / 2 + c * np.maximum(0, np.abs(y - z @ w - fit.intercept) - epsilon).sum()
        assert other >= fit.objective - fit.gap


def test_epsilon_loss_on_few_rows_and_saved(spark, daily):
    """The 25 days with the settings of a support vector regressor: labels far beyond c give almost their median."""
    table = daily_features(daily)
    estimator = KernelRegression(DAILY_FEATURES, "inNums", loss="epsilon")
    model = estimator.fit(table)
    assert estimator.fit_.gap <= 1e-3 * estimator.fit_.objective
    got = predict(table, model).agg(F.min("prediction"), F.max("prediction")).first()
    median = sorted(r["inNums"] for r in daily.collect())[12]
    assert got[1] - got[0] < 100 and abs(got[0] - median) < 100
    path = scratch_path(spark, "svr")
    model.write().save(path)
    assert rows_of(predict(table, PipelineModel.load(path))) == rows_of(predict(table, model))
    with pytest.raises(ValueError):
        KernelRegression(DAILY_FEATURES, "inNums", loss="epsilon").fit(table.where("inNums < 0"))


def test_kernel_features_stand_for_the_gaussian_kernel(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (2.0, 3.0)], "x double, y double")
    model = KernelRegression(["x"], "y", size=1024, gamma=0.7).fit(df)
    rows = model.transform(df).select("x_z", "features").collect()
    # An average of 1024 random waves is off by about 1/32; four times that is allowed.
    for a in rows:
        for b in rows:
            kernel = math.exp(-0.7 * (a["x_z"] - b["x_z"]) ** 2)
            assert float(a["features"].dot(b["features"])) == pytest.approx(kernel, abs=0.125)


def test_scaler_handles_a_constant_column(spark):
    df = spark.createDataFrame([(1, 5), (3, 5)], "a int, b int")
    out = PopulationScaler(["a", "b"]).fit(df).transform(df)
    assert rows_of(out.select("a_z", "b_z")) == [(-1, 0), (1, 0)]


def test_forest_is_repeatable_and_its_trees_can_be_read(wave):
    small = lambda: random_forest(["x", "flat"], "y", trees=5, depth=6)
    one, two = small().fit(wave), small().fit(wave)
    assert rows_of(predict(wave, one)) == rows_of(predict(wave, two))
    assert r2(predict(wave, one)) > 0.95
    assert len(one.stages[-1].trees) == 5 and one.stages[-1].trees[0].depth <= 6


QUICK = {
    "linear": linear,
    "forest": lambda features, label: random_forest(features, label, trees=10, depth=12),
    "rbf_rff": lambda features, label: KernelRegression(features, label),
}


@pytest.fixture(scope="module")
def flow(spark):
    """Three weeks of two target stations and one other; entries rise in the morning."""
    hour = F.hour("startTime")
    busy = F.when(hour.between(7, 9), 40).when(hour.between(6, 20), 10).otherwise(0)
    weekend = F.weekday(F.to_date("startTime")) >= 5
    slots = spark.sql(
        """SELECT stationID, explode(sequence(TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-21 23:50:00',
        INTERVAL '10' MINUTE)) AS startTime FROM VALUES (10L), (12L), (77L) AS t(stationID)"""
    )
    return slots.withColumn("endTime", F.expr("startTime + INTERVAL '10' MINUTE")).withColumns(
        {
            "inNums": (F.when(weekend, 5).otherwise(busy) * F.when(F.col("stationID") == 10, 2).otherwise(1)).cast("long"),
            "outNums": F.lit(3).cast("long"),
        }
    )


@pytest.fixture(scope="module")
def slot_models(flow):
    return fit_slot_models(flow, [10, 12], QUICK)


def test_slot_competition(slot_models):
    board = {(r["day_type"], r["target"], r["model"]): r for r in slot_models.leaderboard.collect()}
    assert len(board) == 2 * 2 * 3
    # 15 weekdays and 6 weekend days of 144 slots at two stations, a fifth held out.
    assert board["weekday", "inNums", "linear"]["n"] == math.ceil(15 * 144 * 2 * 0.2)
    assert board["weekend", "inNums", "linear"]["n"] == math.ceil(6 * 144 * 2 * 0.2)
    winners = {(r["day_type"], r["target"]): r["model"] for r in slot_models.winners.collect()}
    assert winners["weekday", "inNums"] == "forest"
    assert board["weekday", "inNums", "forest"]["r2"] > 0.99
    assert all(math.isfinite(r["mse"]) for r in board.values())
    assert set(slot_models.models) == {(d, t) for d in ("weekday", "weekend") for t in ("inNums", "outNums")}


def test_slot_forecast(spark, flow, slot_models):
    stations = spark.createDataFrame([(10,), (12,), (99,)], "stationID long")
    base = F.lit(day("2024-01-26"))
    out = forecast_slots(slot_models.models, stations, base, 5, [10, 12])
    assert out.count() == 3 * 5 * 144 == out.select("stationID", "startTime").distinct().count()
    assert out.where("inNums < 0 or outNums <> 3").isEmpty()
    peak = out.where((F.col("startTime") == F.lit(at("2024-01-26 08:00:00")).cast("timestamp_ntz")))
    assert {r["stationID"]: r["inNums"] for r in peak.collect()}[10] == 80
    path = scratch_path(spark, "models")
    save_models(slot_models, path)
    again = forecast_slots(load_slot_models(path), stations, base, 5, [10, 12])
    assert again.exceptAll(out).isEmpty() and out.exceptAll(again).isEmpty()


def test_weekdays_only(spark, flow):
    weekdays = flow.where(F.weekday(F.to_date("startTime")) < 5)
    fitted = fit_slot_models(weekdays, [10, 12], {"linear": linear})
    assert set(fitted.models) == {("weekday", "inNums"), ("weekday", "outNums")}
    stations = spark.createDataFrame([(10,)], "stationID long")
    base = F.lit(day("2024-01-26"))
    with pytest.raises(ValueError, match="weekend"):
        forecast_slots(fitted.models, stations, base, 5, [10, 12])
    some = forecast_slots(fitted.models, stations, base, 5, [10, 12], day_types=["weekday"])
    assert some.count() == 3 * 144


def test_slot_fits_do_not_depend_on_the_cores(flow):
    """The same rows in other partitions give the same scores; no tree reaches Spark's limit of depth."""
    quick = {"forest": lambda features, label: random_forest(features, label, trees=5, depth=30)}
    boards = []
    for parts in (1, 3, 7):
        fitted = fit_slot_models(flow.repartition(parts), [10, 12], quick)
        boards.append(rows_of(fitted.leaderboard))
    assert boards[0] == boards[1] == boards[2]
    assert max(t.depth for m in fitted.models.values() for t in m.stages[-1].trees) < 30


def test_split_by_time_and_one_hot(flow):
    fitted = fit_slot_models(flow, [10, 12], {"linear": linear}, split="time", onehot=["hour"])
    assert fitted.features[0] == "hour_0" and "hour" not in fitted.features and "minute" in fitted.features
    board = {(r["day_type"], r["target"]): r for r in fitted.leaderboard.collect()}
    assert board["weekday", "inNums"]["n"] == 3 * 144 * 2 and board["weekday", "inNums"]["r2"] > 0.5
    with pytest.raises(ValueError):
        fit_slot_models(flow, [10], {"linear": linear}, split="other")
    with pytest.raises(ValueError):
        fit_slot_models(flow, [10], {"linear": linear}, onehot=["day"])


def test_daily_competition_and_recursive_forecast(spark, daily):
    fitted = fit_daily_models(daily, QUICK)
    board = fitted.leaderboard.collect()
    assert {(r["target"], r["model"]) for r in board} == {(t, m) for t in ("inNums", "outNums") for m in QUICK}
    best = {r["target"]: r["r2_mean"] for r in fitted.winners.collect()}
    for r in board:
        assert r["r2_mean"] <= best[r["target"]] and r["rmse_mean"] > 0 and r["r2_std"] >= 0
    forecast = forecast_recursive(daily, model_predictor(fitted.models), 6)
    rows = forecast.orderBy("date").collect()
    assert [r["date"].day for r in rows] == [26, 27, 28, 29, 30, 31]
    assert [r["dayOfWeek"] for r in rows] == [5, 6, 0, 1, 2, 3] and all(r["isPrediction"] for r in rows)
    assert all(900_000 < r["inNums"] < 1_500_000 for r in rows)
    path = scratch_path(spark, "daily")
    save_models(fitted, path)
    loaded = load_daily_models(path)
    assert all(isinstance(m, PipelineModel) for m in loaded.values())
    assert rows_of(forecast_recursive(daily, model_predictor(loaded), 6)) == rows_of(forecast)


def brute_recursive(history, line, horizon, roll):
    tail, now, out = list(history[-7:]), history[-1], []
    mean = sum(tail) / len(tail)
    for _ in range(horizon):
        now = round(line[""] + line["prev_day_in"] * now + line["rolling_mean_in_7d"] * mean)
        out.append(now)
        if roll == "update":
            tail = (tail + [now])[-7:]
            mean = sum(tail) / len(tail)
    return out


@pytest.mark.parametrize("roll", ["frozen", "update"])
@pytest.mark.parametrize("days", [1, 3, 7, 25])
def test_recursion_against_brute_force(spark, roll, days):
    line = {"": 3.0, "prev_day_in": 0.5, "rolling_mean_in_7d": 0.625}
    series = {k: [(k * 37 + d * d * 11) % 90 for d in range(days)] for k in range(4)}
    daily = spark.createDataFrame(
        [(k, day(f"2019-01-{d + 1:02d}"), v, 0) for k, values in series.items() for d, v in enumerate(values)],
        "k int, date date, inNums long, outNums long",
    )
    out = forecast_recursive(daily, linear_predictor(line, {"": 1.0}), 9, ["k"], roll=roll)
    got = {k: [] for k in series}
    for r in out.orderBy("k", "date").collect():
        got[r["k"]].append(r["inNums"])
    assert got == {k: brute_recursive(v, line, 9, roll) for k, v in series.items()}


@pytest.mark.parametrize("roll", ["frozen", "update"])
def test_folded_days_equal_unrolled_columns(daily, roll):
    """The same lines as columns step by step, with all calendar features and negative results."""
    lines = [
        {"": -9.5, "dayOfWeek": 1.25, "dayOfMonth": -0.5, "isWeekend": 3.0, "week_number": 0.125, "prev_day_in": 0.5, "rolling_mean_in_7d": 0.25},
        {"": -2e6, "prev_day_out": 0.75, "prev_day_in": 0.125, "rolling_mean_out_7d": 0.5, "rolling_mean_in_7d": 0.0625},
    ]
    folded = linear_predictor(*lines)
    for clamp in (False, True):
        unrolled = forecast_recursive(daily, lambda df: folded(df), 5, roll=roll, clamp=clamp)
        ours = forecast_recursive(daily, folded, 5, roll=roll, clamp=clamp)
        assert ours.columns == unrolled.columns and rows_of(ours) == rows_of(unrolled)
    assert forecast_recursive(daily, folded, 0, roll=roll).count() == 0
    assert forecast_recursive(daily.where("inNums < 0"), folded, 5, roll=roll).count() == 0


def test_plan_does_not_grow_with_the_horizon(daily):
    def plan(horizon):
        df = forecast_recursive(daily, linear_predictor({"": 1.0, "prev_day_in": 0.5}, {"": 1.0}), horizon, roll="update")
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert abs(len(plan(62)) - len(plan(6))) < 2_000 and len(plan(400)) < 2 * len(plan(6)) + 4_000
    df = forecast_recursive(daily, linear_predictor({"": 7.0}, {"": 1.0}), 400)
    assert df.count() == 400


def test_recursive_clamp_is_a_choice(daily):
    below = linear_predictor({"": -5.0}, {"": -5.0})
    assert forecast_recursive(daily, below, 1).first()["inNums"] == -5
    assert forecast_recursive(daily, below, 1, clamp=True).first()["inNums"] == 0
    with pytest.raises(ValueError):
        forecast_recursive(daily, below, 1, roll="other")


def test_report_text(spark, daily):
    forecast = forecast_recursive(daily, linear_predictor({"": 1082152.0}, {"": 1083120.0}), 1)
    report = build_report(
        daily.withColumn("dayOfWeek", F.weekday("date")).withColumn("extra", F.lit(1)), forecast
    )
    assert report.columns == ["日期", "星期", "进站人数", "出站人数", "数据类型"]
    rows = rows_of(report)
    assert len(rows) == 26
    assert rows[0] == ("2019-01-01", "周二", "1,270,547", "1,269,045", "实际值")
    assert rows[24] == ("2019-01-25", "周五", "1,288,580", "1,287,602", "实际值")
    assert rows[25] == ("2019-01-26", "周六", "1,082,152", "1,083,120", "预测值")


def test_labels_fitted_together_are_as_fitted_alone(spark, monkeypatch):
    """The passes are those of the longest fit, not of all; a row without one label counts for the other."""
    import flowgauge.models.support_vectors as support_vectors

    passes, total = [], support_vectors._total
    monkeypatch.setattr(support_vectors, "_total", lambda *a: passes.append(1) or total(*a))
    rows = [(float(i % 17), float(i % 5), float(i % 7) if i % 10 else None, float(i % 3 * (i % 17))) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, u double, v double").repartition(2)
    made = lambda label: KernelRegression(["a", "b"], label, size=8, loss="epsilon")
    alone = []
    for label in "uv":
        alone.append(made(label))
        alone[-1].fit(df)
    apart, together = len(passes), [made(label) for label in "uv"]
    passes.clear()
    fit_labels(df, together)
    assert len(passes) == max(e.fit_.passes for e in together) < apart
    for a, b in zip(alone, together, strict=True):
        assert a.fit_.weights == pytest.approx(b.fit_.weights, abs=1e-6) and b.fit_.gap <= 1e-3 * b.fit_.objective
    with pytest.raises(ValueError):
        fit_labels(df, [made("u"), KernelRegression(["a"], "v", loss="epsilon")])
