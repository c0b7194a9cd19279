"""Reading swipe files, flow tables and reports."""

import datetime
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.functions.numfns import number_from_thousands
from flowgauge.sources.fixed_values import REPORT_COLUMNS
from flowgauge.sources.ledger import date_in, file_ledger
from flowgauge.sources.schemas import BAD_RECORD, FLOW, REPORT, SWIPE


def _csv_files(
    spark: SparkSession, path: str | list[str], declared: T.StructType, header: tuple[str, ...] | None = None
) -> DataFrame:
    """Declared types in the order of the files' own header; other columns are text.

    Where ``header`` is given, all files are known to have it.
    """
    reader, known = spark.read.option("header", True), header is not None
    header = header if known else reader.csv(path).columns
    types = {field.name: field.dataType for field in declared}
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    return (
        reader.schema(T.StructType([*fields, T.StructField(BAD_RECORD, T.StringType())]))
        .option("enforceSchema", known)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        .csv(path)
    )


def read_swipes(
    spark: SparkSession, path: str | list[str], declared: T.StructType = SWIPE, keep_bad: bool = False
) -> DataFrame:
    """Headered swipe files in one distributed read.

    Columns are found by name and all files must have the same header. A line that does not
    parse keeps what could be read; ``keep_bad`` adds the line itself as ``_bad``.
    """
    df = _csv_files(spark, path, declared)
    return df if keep_bad else df.drop(BAD_RECORD)


def read_days(
    spark: SparkSession,
    folder: str,
    start: datetime.date,
    end: datetime.date,
    declared: T.StructType = SWIPE,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Swipe files of a range of days, with the ``date`` that stands in each file's path.

    ``record_2024-01-05.csv`` and ``day=2024-01-05/part-0.csv`` are both found. Files of other days,
    and files without a date in their path, are not opened. Columns are found by name in every
    file: files are read together by header, and a column that some lack is null there. Every file
    is decoded once before (``file_ledger``): those that are broken or cut off anywhere, or lack a
    needed column, are left out as a whole; ``skipped_files`` tells which and why, and
    ``missing_days`` the days without rows. Any other error ends the read. ``ledger`` is the table
    of ``file_ledger``, for callers that also ask for the skipped files.
    """
    ledger = file_ledger(spark, folder, start, end) if ledger is None else ledger
    good = ledger.where("fault is null").groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    day = date_in("_metadata.file_path")
    parts = [
        _csv_files(spark, paths, declared, tuple(header)).withColumn("date", day).drop(BAD_RECORD)
        for header, paths in sorted(good.collect())
    ]
    if not parts:
        fields = T.StructType([*declared.fields, T.StructField("date", T.DateType())])
        return spark.createDataFrame([], fields)
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def skipped_files(ledger: DataFrame) -> DataFrame:
    """``file`` and ``reason`` of the files that ``read_days`` leaves out, those of other days aside."""
    return ledger.where("fault is not null").select(F.substring_index("path", "/", -1).alias("file"), F.col("fault").alias("reason"))


def days_with_files(ledger: DataFrame) -> DataFrame:
    """``date``: the days that stand in the paths of the files that are read."""
    return ledger.where("fault is null").select("date").distinct()


def read_flow(
    spark: SparkSession,
    path: str,
    start: datetime.date | None = None,
    end: datetime.date | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A flow table written by ``write_flow``, as Parquet or CSV; a range of days reads only their partitions."""
    if fmt == "csv":
        kinds = T.StructType([*FLOW.fields, T.StructField("date", T.DateType())])
        df = spark.read.schema(kinds).option("header", True).csv(path)
    else:
        df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end))
    return df


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report as text, plus the two counts as numbers in ``inNums`` and ``outNums``."""
    text = spark.read.schema(REPORT).option("header", True).csv(path)
    return text.withColumns(
        {
            "inNums": number_from_thousands(REPORT_COLUMNS[2]),
            "outNums": number_from_thousands(REPORT_COLUMNS[3]),
        }
    )
