"""Line and station names as small tables."""

from pyspark.sql import DataFrame, SparkSession

from flowgauge.sources.fixed_values import LINE_NAMES, STATION_NAMES, TARGET_STATION_LABELS


def _inline(spark: SparkSession, rows: list[tuple[str, str]], columns: str) -> DataFrame:
    values = ", ".join(f"({key}, '{name}')" for key, name in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def line_dim(spark: SparkSession) -> DataFrame:
    """Three lines: ``lineID``, ``lineName``."""
    return _inline(spark, [(f"'{k}'", v) for k, v in LINE_NAMES.items()], "lineID, lineName")


def station_dim(spark: SparkSession) -> DataFrame:
    """81 stations: ``stationID``, ``stationName``."""
    return _inline(spark, [(f"{k}L", v) for k, v in enumerate(STATION_NAMES)], "stationID, stationName")


def target_label_dim(spark: SparkSession) -> DataFrame:
    """Chart labels of the default target stations: ``stationID``, ``stationName``."""
    return _inline(spark, [(f"{k}L", v) for k, v in TARGET_STATION_LABELS.items()], "stationID, stationName")
