"""Roll-up and gap filling by hand and against brute force."""

import datetime
import random

import pytest
from conftest import at, day, rows_of
from pyspark.sql import functions as F

from flowgauge.functions.timefns import step_seconds
from flowgauge.operators.flow import daily_totals, merge_directions
from flowgauge.operators.series import gap_fill
from flowgauge.plans.rollup import daily_flow, observed_flow, station_flow


def test_group_bounds(swipes):
    df = swipes([("00:12:00", 1, "A", 1), ("00:45:00", 1, "A", 1), ("01:00:00", 2, "A", 1)])
    flow = station_flow(df, bounds="group")
    assert rows_of(flow.select("stationID", F.date_format("startTime", "HH:mm"), "inNums", "outNums")) == [
        (1, "00:10", 1, 0),
        (1, "00:20", 0, 0),
        (1, "00:30", 0, 0),
        (1, "00:40", 1, 0),
        (2, "01:00", 1, 0),
    ]


def test_global_bounds_cover_whole_days_of_every_station(swipes):
    df = swipes([("2024-01-01 05:06:07.179575", 1, "A", 1), ("2024-01-02 23:59:59.999999", 2, "A", 0)])
    flow = station_flow(df)
    assert flow.count() == 2 * 2 * 144
    ends = flow.agg(F.min("startTime"), F.max("startTime"), F.max("endTime"), F.sum("inNums"), F.sum("outNums"))
    assert rows_of(ends) == [
        (at("2024-01-01 00:00:00"), at("2024-01-02 23:50:00"), at("2024-01-03 00:00:00"), 1, 1)
    ]
    assert flow.where("stationID = 1").count() == 288


def test_same_slot_is_summed_and_other_status_ignored(swipes):
    df = swipes([("00:01:00", 1, "A", s) for s in (1, 1, 0, 2, None)])
    assert rows_of(observed_flow(df).select("inNums", "outNums")) == [(2, 1)]


def test_null_station_and_null_time_are_left_out(swipes):
    df = swipes([("00:01:00", None, "A", 1), (None, 1, "A", 1), ("00:01:00", 1, "A", 1)])
    flow = station_flow(df)
    assert flow.count() == 144 and flow.agg(F.sum("inNums")).first()[0] == 1


def test_empty_in_empty_out(swipes):
    flow = station_flow(swipes([]))
    assert flow.columns == ["stationID", "startTime", "endTime", "inNums", "outNums"]
    assert flow.isEmpty()


@pytest.mark.parametrize("step", ["7 minutes", "25 hours", "0 minutes", "fortnight", ""])
def test_steps_that_do_not_divide_a_day(step):
    with pytest.raises(ValueError):
        step_seconds(step)


@pytest.mark.parametrize("step,seconds", [("10T", 600), ("10min", 600), ("H", 3600), ("1 day", 86400), ("30s", 30)])
def test_steps(step, seconds):
    assert step_seconds(step) == seconds


@pytest.mark.parametrize("seed,step,bounds", [(1, 10, "global"), (2, 30, "group"), (3, 360, "global"), (4, 10, "group")])
def test_gap_fill_against_brute_force(swipes, seed, step, bounds):
    draw = random.Random(seed)
    base = datetime.datetime(2024, 1, 1)
    events = []
    for _ in range(200):
        station = 0 if draw.random() < 0.4 else draw.randrange(6)
        time = base + datetime.timedelta(seconds=draw.randrange(3 * 86400), microseconds=draw.randrange(10**6))
        events.append((time, station, draw.choice([0, 1, 2])))
    width = datetime.timedelta(minutes=step)
    counts = {}
    for time, station, status in events:
        if status < 2:
            slot = base + (time - base) // width * width
            one = counts.setdefault((station, slot), [0, 0])
            one[1 - status] += 1
    expected = []
    slots = [s for _, s in counts]
    for station in {s for s, _ in counts}:
        own = [s for k, s in counts if k == station]
        if bounds == "global":
            lo = min(slots).replace(hour=0, minute=0)
            hi = max(slots).replace(hour=0, minute=0) + datetime.timedelta(days=1) - width
        else:
            lo, hi = min(own), max(own)
        while lo <= hi:
            expected.append((station, lo, lo + width, *counts.get((station, lo), (0, 0))))
            lo += width
    df = swipes([(t.isoformat(" "), s, "A", st) for t, s, st in events])
    assert rows_of(station_flow(df, f"{step} minutes", bounds=bounds)) == sorted(expected, key=str)


def test_gap_fill_keeps_null_and_negative_values(spark):
    df = spark.createDataFrame(
        [(1, at("2024-01-01 00:00"), None), (1, at("2024-01-01 12:00"), -5)], "k int, t timestamp_ntz, v int"
    )
    filled = gap_fill(df, ["k"], "t", "6 hours", ["v"])
    assert rows_of(filled.select(F.hour("t"), "v")) == sorted([(0, None), (6, 0), (12, -5), (18, 0)], key=str)


def test_daily_flow_equals_daily_totals_of_the_dense_flow(swipes):
    df = swipes(
        [("2024-01-01 08:00:00", 1, "A", 1), ("2024-01-04 08:00:00", 2, "A", 0), ("2024-01-04 09:00:00", 1, "A", 1)]
    )
    expected = [
        (day("2024-01-01"), 1, 0),
        (day("2024-01-02"), 0, 0),
        (day("2024-01-03"), 0, 0),
        (day("2024-01-04"), 1, 1),
    ]
    assert rows_of(daily_flow(df)) == expected
    assert rows_of(daily_totals(station_flow(df))) == expected
    by_station = rows_of(daily_flow(df, ["stationID"]))
    assert by_station == rows_of(daily_totals(station_flow(df), ["stationID"])) and len(by_station) == 8


def test_merge_directions_keeps_one_sided_slots(spark):
    ins = spark.createDataFrame([(1, 10, 4), (1, 20, 5)], "stationID long, startTime long, inNums long")
    outs = spark.createDataFrame([(1, 20, 7), (2, 20, 8)], "stationID long, startTime long, outNums long")
    assert rows_of(merge_directions(ins, outs)) == [(1, 10, 4, 0), (1, 20, 5, 7), (2, 20, 0, 8)]


def test_hot_station_gives_the_same_result_at_any_partitioning(swipes):
    rows = [(f"{h:02d}:{m:02d}:00", 1, "A", 1) for h in range(24) for m in range(0, 60, 3)] + [("12:00:00", 2, "A", 0)]
    df = swipes(rows)
    assert rows_of(station_flow(df.repartition(1))) == rows_of(station_flow(df.repartition(37, "time")))
