"""Names for station and line ids."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.numfns import station_label
from flowgauge.sources.dims import line_dim, station_dim


def with_station_name(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Add ``stationName``, null where unknown.

    The built-in table has 81 rows and is broadcast; for a table of the caller's the
    optimizer decides by its size.
    """
    names = F.broadcast(station_dim(df.sparkSession)) if dim is None else dim
    return df.join(names, "stationID", "left")


def with_line_name(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Add ``lineName``, null where unknown. The built-in table has three rows."""
    names = F.broadcast(line_dim(df.sparkSession)) if dim is None else dim
    return df.join(names, "lineID", "left")


def with_station_label(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Add ``stationLabel``: the name, or a default made from the id."""
    named = with_station_name(df, dim)
    return named.withColumn("stationLabel", station_label("stationName", "stationID")).drop("stationName")
