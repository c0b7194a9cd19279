"""Writing flow tables, forecasts, reports and the tables behind charts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions.timefns import time_text
from flowgauge.sources.fixed_values import REPORT_COLUMNS

BYTE_ORDER_MARK = "﻿"

#: Rows that a task sorts before it writes them.
ROWS_AT_ONCE = 2_000_000


def _with_time_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: time_text(c) for c, kind in df.dtypes if kind == "timestamp_ntz"})


def write_flow(df: DataFrame, path: str, fmt: str = "parquet", time: str = "startTime", compression: str = "none") -> None:
    """Write a flow table, one partition per day: Parquet to work on, CSV to hand out, which large tables want as "gzip".

    Rows are dealt by ranges of day, station and time, each small enough to be sorted in memory, so that small days share
    no file with others and a day too large for one task is split over several. ``df`` is counted before and is read once more
    to find the ranges.
    """
    dated = df.withColumn("date", F.to_date(time))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_AT_ONCE))
    order = ["date", "stationID", time]
    ordered = dated.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    if fmt == "csv":
        ordered = _with_time_text(ordered)
    writer = ordered.write.mode("overwrite").partitionBy("date")
    if fmt == "csv":
        writer.option("header", True).option("compression", compression).csv(path)
    else:
        writer.format(fmt).save(path)


def write_forecast(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write slot forecasts as headered CSV, sorted, with times as text; large ones want ``compression="gzip"``.

    Rows go by ranges, each small enough to be sorted in memory.
    """
    rows = df.select("stationID", "startTime", "endTime", "inNums", "outNums")
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_AT_ONCE))
    order = ["stationID", "startTime"]
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    writer = _with_time_text(sorted_).write.mode("overwrite").option("header", True)
    writer.option("compression", compression).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """Write the daily report as one CSV file, UTF-8 with byte order mark.

    A report has one row per day, so one file and one task is right. The mark is the first
    character of the header.
    """
    report = df.select(*REPORT_COLUMNS).coalesce(1).sortWithinPartitions(REPORT_COLUMNS[0])
    marked = report.withColumnRenamed(REPORT_COLUMNS[0], BYTE_ORDER_MARK + REPORT_COLUMNS[0])
    marked.write.mode("overwrite").option("header", True).csv(path)


def write_chart_feed(df: DataFrame, path: str, by: list[str]) -> None:
    """Write the table behind a set of charts, one folder per chart."""
    balanced = df.hint("rebalance", *[F.col(c) for c in by])
    balanced.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_swipes(df: DataFrame, path: str) -> None:
    """Write swipes as headered CSV with full time precision."""
    df.write.mode("overwrite").option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """One small file as it is, through the file system that Spark uses for the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
