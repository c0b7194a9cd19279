"""Declared schemas; nothing is inferred from data."""

from pyspark.sql import types as T

from flowgauge.sources.fixed_values import REPORT_COLUMNS

BAD_RECORD = "_bad"

SWIPE = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("lineID", T.StringType()),
        T.StructField("stationID", T.IntegerType()),
        T.StructField("deviceID", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("payType", T.IntegerType()),
    ]
)

FLOW = T.StructType(
    [
        T.StructField("stationID", T.LongType()),
        T.StructField("startTime", T.TimestampNTZType()),
        T.StructField("endTime", T.TimestampNTZType()),
        T.StructField("inNums", T.LongType()),
        T.StructField("outNums", T.LongType()),
    ]
)

REPORT = T.StructType([T.StructField(name, T.StringType()) for name in REPORT_COLUMNS])
