import datetime

from conftest import day, rows_of
from pyspark.sql import functions as F

from flowgauge.operators.quality import missing_days, quality_audit, unmapped
from flowgauge.operators.rows import (
    align_columns,
    day_slice,
    first_rows,
    for_stations,
    is_empty,
    last_row,
    last_rows,
    split_day_type,
)
from flowgauge.plans.cleaning import clean_swipes

RAW = "time string, lineID string, stationID int, deviceID int, status int, payType int"


def raw(spark):
    return spark.createDataFrame(
        [
            ("t1", "A", 1, 100, 1, 1),
            ("t1", "A", 1, 101, 1, 2),
            ("t2", "A", None, 102, 1, 1),
            ("t2", "A", None, 103, 1, 1),
            ("t3", "B", 2, None, 0, None),
        ],
        RAW,
    )


def test_cleaning_drops_columns_then_duplicates_then_nulls(spark):
    cleaned = clean_swipes(raw(spark))
    assert cleaned.columns == ["time", "lineID", "stationID", "status"]
    assert rows_of(cleaned) == [("t1", "A", 1, 1), ("t3", "B", 2, 0)]


def test_cleaning_without_the_unused_columns(spark):
    assert clean_swipes(raw(spark).drop("payType", "deviceID")).count() == 2


def test_cleaning_of_an_empty_table(spark):
    assert clean_swipes(raw(spark).limit(0)).columns == ["time", "lineID", "stationID", "status"]


def test_audit_counts(spark):
    audit = quality_audit(raw(spark).drop("payType", "deviceID")).first().asDict()
    assert audit == {
        "rows": 5,
        "duplicate_rows": 2,
        "null_cells": 1,
        "incomplete_rows": 1,
        "clean_rows": 2,
        "null_time": 0,
        "null_lineID": 0,
        "null_stationID": 1,
        "null_status": 0,
    }


def test_audit_of_an_empty_table(spark):
    assert set(quality_audit(raw(spark).limit(0)).first()) == {0}


def test_unmapped_lists_each_id_once_and_null(spark):
    df = spark.createDataFrame([(99,), (99,), (1,), (None,)], "stationID int")
    dim = spark.createDataFrame([(1, "x")], "stationID int, stationName string")
    assert rows_of(unmapped(df, dim, "stationID")) == [(99,), (None,)]


def test_missing_days(spark):
    days = ["2024-02-27", "2024-03-01"]
    df = spark.createDataFrame([(day(d), i) for i, d in enumerate(days)], "date date, k int")
    assert rows_of(missing_days(df, day("2024-02-27"), day("2024-03-02"))) == [
        (day("2024-02-28"),),
        (day("2024-02-29"),),
        (day("2024-03-02"),),
    ]
    assert missing_days(df, day("2024-02-27"), day("2024-03-02"), keys=["k"]).count() == 8


def test_station_filters(spark):
    df = spark.range(1000).withColumnRenamed("id", "stationID")
    many = list(range(0, 1000, 2)) + [998, 999]
    assert for_stations(df, [3, 5]).count() == 2
    assert for_stations(df, many).count() == 501
    assert for_stations(df, df.where("stationID < 7")).count() == 7


def test_day_types_and_slices(spark):
    df = spark.range(14).select(
        F.lit(1).alias("stationID"),
        (F.lit(datetime.datetime(2024, 1, 1)) + F.make_dt_interval(F.col("id").cast("int"))).cast("timestamp_ntz").alias("startTime"),
    ).withColumn("date", F.to_date("startTime"))
    weekdays, weekend = split_day_type(df)
    assert (weekdays.count(), weekend.count()) == (10, 4)
    assert day_slice(df, 1, day("2024-01-07")).count() == 1
    assert is_empty(day_slice(df, 2, day("2024-01-07")))


def test_align_fills_absent_columns(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert rows_of(align_columns(df, ["a", "station_7", "b"])) == [(2, 0, 1)]


def test_first_and_last_rows(spark):
    df = spark.createDataFrame([(k, i, i * 10) for k in "xy" for i in range(5)], "k string, o int, v int")
    assert rows_of(first_rows(df, ["o", "k"], 3)) == [("x", 0, 0), ("x", 1, 10), ("y", 0, 0)]
    assert rows_of(last_rows(df, "o", 2, ["k"])) == [("x", 3, 30), ("x", 4, 40), ("y", 3, 30), ("y", 4, 40)]
    assert rows_of(last_row(df, "o", ["k"])) == [("x", 4, 40), ("y", 4, 40)]
    assert last_row(df.limit(0), "o").isEmpty()
