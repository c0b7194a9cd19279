import datetime
import math

import numpy as np
import pandas as pd
import pytest
from conftest import at, day, rows_of
from pyspark.sql import functions as F

from flowgauge.operators.lookup import with_station_label
from flowgauge.operators.series import lag_or_self, linspace_grid, rolling_mean
from flowgauge.operators.spline import spline_densify, spline_values
from flowgauge.plans.profiles import date_label, line_hourly_counts, line_hourly_profile, line_station_profile
from flowgauge.sources.dims import line_dim, station_dim


def test_dims(spark):
    stations = station_dim(spark)
    assert stations.count() == 81 and stations.select("stationName").distinct().count() == 80
    assert rows_of(stations.where("stationName = '凤起路'").select("stationID")) == [(10,), (51,)]
    assert line_dim(spark).count() == 3


def test_shared_name_is_placed_by_its_largest_id(swipes):
    df = swipes([("08:00:00", 10, "C", 1), ("08:00:00", 51, "D", 1), ("08:00:00", 50, "C", 1), ("08:00:00", 12, "C", 1)])
    by_name = line_station_profile(df).select("stationName", "station_order").collect()
    assert [tuple(r) for r in by_name] == [("西湖文化广场", 12), ("中河北路", 50), ("凤起路", 51)]
    by_id = line_station_profile(df, order="by_id").select("stationName", "station_order").collect()
    assert [tuple(r) for r in by_id] == [("凤起路", 10), ("西湖文化广场", 12), ("中河北路", 50)]
    with pytest.raises(ValueError):
        line_station_profile(df, order="other")


def test_profile_counts_boardings_with_both_names(swipes):
    df = swipes([("08:00:00", 1, "A", 1), ("09:00:00", 1, "A", 1), ("08:00:00", 1, "A", 0), ("08:00:00", 99, "A", 1), ("08:00:00", 1, None, 1)])
    assert rows_of(line_station_profile(df)) == [("杭州地铁4号线", "滨康路", 2, 1)]


def test_hourly_gaps_lie_between_a_lines_own_hours(swipes):
    df = swipes([("00:12:00", 1, "A", 1), ("02:12:00", 1, "A", 1), ("05:00:00", 1, "B", 1), (None, 1, "B", 1)])
    hourly = line_hourly_counts(df).select("lineName", F.hour("time"), "count")
    assert rows_of(hourly) == [("杭州地铁1号线", 5, 1), ("杭州地铁4号线", 0, 1), ("杭州地铁4号线", 1, 0), ("杭州地铁4号线", 2, 1)]


def test_rolling_mean_starts_short(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([3, 6, 9, 12])], "o int, v int")
    out = rolling_mean(df, [], "o", "v", 3, "m")
    assert [r["m"] for r in out.orderBy("o").collect()] == [3, 4.5, 6, 9]
    before = rolling_mean(df, [], "o", "v", 3, "m", include_current=False)
    assert [r["m"] for r in before.orderBy("o").collect()] == [None, 3, 4.5, 6]


def test_lag_of_the_first_row_is_itself(spark):
    df = spark.createDataFrame([(0, 5), (1, 7)], "o int, v int")
    assert rows_of(lag_or_self(df, [], "o", "v", "p")) == [(0, 5, 5), (1, 7, 5)]


def test_smoothed_profile(swipes):
    df = swipes([("00:12:00", 1, "A", 1)] * 3 + [("02:12:00", 1, "A", 1)] * 3)
    assert [r["count_smoothed"] for r in line_hourly_profile(df).orderBy("time").collect()] == [3, 1.5, 2]


def test_station_label_default(spark):
    df = spark.createDataFrame([(1,), (99,)], "stationID long")
    assert rows_of(with_station_label(df)) == [(1, "滨康路"), (99, "站点99")]


@pytest.mark.parametrize("knots", [4, 5, 24])
def test_spline_reproduces_a_cubic(knots):
    x = np.linspace(0, 3, knots)
    at_ = np.linspace(0, 3, 300)
    cubic = lambda v: v**3 - 2 * v**2 + 1
    assert np.abs(spline_values(x, cubic(x), at_) - cubic(at_)).max() < 1e-9


def test_spline_with_uneven_knots_is_smooth_and_passes_through():
    x = np.array([0.0, 1.0, 1.5, 4.0, 4.2, 7.0])
    y = np.array([1.0, -2.0, 0.5, 3.0, 2.0, 2.5])
    assert np.allclose(spline_values(x, y, x), y)
    # Not-a-knot: the third derivative does not jump at the second and the last but one knot.
    for knot in (x[1], x[-2]):
        h = 0.02
        thirds = []
        for side in (-1, 1):
            p = knot + side * h * np.arange(1, 5)
            v = spline_values(x, y, p)
            thirds.append(side * (v[3] - 3 * v[2] + 3 * v[1] - v[0]) / h**3)
        assert thirds[0] == pytest.approx(thirds[1], rel=1e-4)


def test_spline_against_a_dense_solver():
    draw = np.random.default_rng(5)
    x = np.cumsum(draw.uniform(0.2, 2.0, 12))
    y = draw.normal(size=12)
    n = len(x)
    # Piece i is a + b t + c t^2 + d t^3 with t = v - x[i].
    rows, right = [], []

    def put(entries, value):
        row = np.zeros(4 * (n - 1))
        for piece, power, factor in entries:
            row[4 * piece + power] = factor
        rows.append(row)
        right.append(value)

    for i in range(n - 1):
        h = x[i + 1] - x[i]
        put([(i, 0, 1)], y[i])
        put([(i, 0, 1), (i, 1, h), (i, 2, h**2), (i, 3, h**3)], y[i + 1])
        if i < n - 2:
            put([(i, 1, 1), (i, 2, 2 * h), (i, 3, 3 * h * h), (i + 1, 1, -1)], 0)
            put([(i, 2, 2), (i, 3, 6 * h), (i + 1, 2, -2)], 0)
    put([(0, 3, 1), (1, 3, -1)], 0)
    put([(n - 3, 3, 1), (n - 2, 3, -1)], 0)
    c = np.linalg.solve(np.array(rows), np.array(right))
    points = np.linspace(x[0], x[-1], 77)
    piece = np.clip(np.searchsorted(x, points, side="right") - 1, 0, n - 2)
    t = points - x[piece]
    expected = sum(c[4 * piece + k] * t**k for k in range(4))
    assert np.allclose(spline_values(x, y, points), expected, atol=1e-9)


def test_spline_densify_times_and_short_series(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [("long", start + datetime.timedelta(hours=i), float(i * i)) for i in range(6)]
    rows += [("short", start + datetime.timedelta(hours=i), float(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    out = spline_densify(df, "k", "t", "v", 11).toPandas()
    assert dict(out.groupby("k").size()) == {"long": 11, "short": 3}
    curve = out[out.k == "long"].sort_values("t")
    hours = (curve.t - pd.Timestamp(start)).dt.total_seconds() / 3600
    assert np.allclose(hours, np.linspace(0, 5, 11)) and np.allclose(curve.v, hours**2)


def test_linspace_of_numbers_and_times(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "k string, x double")
    assert [r["x"] for r in linspace_grid(df, "k", "x", 5).orderBy("point").collect()] == [1, 1.5, 2, 2.5, 3]
    times = spark.createDataFrame([("a", at("2024-01-01 00:00")), ("a", at("2024-01-01 01:00"))], "k string, x timestamp_ntz")
    assert [r["x"].minute for r in linspace_grid(times, "k", "x", 4).orderBy("point").collect()] == [0, 20, 40, 0]


def test_date_label(swipes):
    one = swipes([("00:00:00", 1, "A", 1), ("23:00:00", 1, "A", 1)])
    assert rows_of(date_label(one)) == [("2024-01-01 (Monday)",)]
    two = swipes([("00:00:00", 1, "A", 1), ("2024-01-02 00:00:00", 2, "A", 1)])
    assert rows_of(date_label(two)) == [("多天数据",)]
    assert rows_of(date_label(two, by=["stationID"])) == [(1, "2024-01-01 (Monday)"), (2, "2024-01-02 (Tuesday)")]
    assert day("2024-01-01").strftime("%A") == "Monday"


@pytest.mark.parametrize("block", [4, 5, 8, 100])
@pytest.mark.parametrize("n", [4, 5, 7, 8, 9, 16, 41])
def test_spline_by_blocks_is_the_spline(spark, block, n):
    """Uneven knots, two series and a null key, points that fall on knots, cuts anywhere."""
    draw = np.random.default_rng(n)
    series = {k: (np.cumsum(draw.uniform(0.2, 2.0, n + i)), draw.normal(size=n + i)) for i, k in enumerate(["a", "b", None])}
    rows = [(k, float(u), float(v)) for k, (xs, ys) in series.items() for u, v in zip(xs, ys, strict=True)]
    draw.shuffle(rows)
    df = spark.createDataFrame([(r[0], float(r[1]), float(r[2])) for r in rows], "k string, x double, y double").repartition(3)
    got = {}
    for r in spline_densify(df, "k", "x", "y", 61, block).collect():
        got.setdefault(r["k"], []).append((r["x"], r["y"]))
    for k, (xs, ys) in series.items():
        at_ = np.linspace(xs[0], xs[-1], 61)
        mine = sorted(got[k])
        assert [m[0] for m in mine] == pytest.approx(at_.tolist(), abs=1e-12)
        assert [m[1] for m in mine] == pytest.approx(spline_values(xs, ys, at_).tolist(), abs=1e-9)


def test_spline_of_a_long_series_takes_many_tasks(spark):
    """Two million knots in blocks of some 65,000: groups of that size, and the curve of the one series."""
    n = 2_000_000
    df = spark.range(n).select(F.lit("a").alias("k"), (F.col("id") / 1000).alias("x"), F.sin(F.col("id") / 100_000).alias("y"))
    out = spline_densify(df, "k", "x", "y", 300)
    rows = sorted((r["x"], r["y"]) for r in out.collect())
    assert len(rows) == 300
    assert max(abs(v - math.sin(u / 100)) for u, v in rows) < 1e-9


def test_spline_times_do_not_depend_on_the_time_zone(spark):
    start = datetime.datetime(2024, 3, 31, 0, 0, 0, 250_001)
    rows = [("a", start + datetime.timedelta(minutes=30 * i), float(i % 3)) for i in range(9)]
    got = []
    for zone in ("UTC", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
            got.append(sorted(tuple(r) for r in spline_densify(df, "k", "t", "v", 33).collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == got[1] and got[0][0][1] == start and got[0][-1][1] == rows[-1][1]
