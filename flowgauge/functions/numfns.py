"""Number and label expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge.sources.fixed_values import ACTUAL_LABEL, FORECAST_LABEL, STATION_PREFIX, WEEKDAY_LABELS


def half_even(value: Column | str) -> Column:
    """Round to the nearest integer, ties to even."""
    return F.bround(value, 0).cast("bigint")


def clamp_zero(value: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), value)


def thousands(value: Column | str) -> Column:
    """``1270547`` as ``1,270,547``."""
    return F.format_number(value, 0)


def number_from_thousands(text: Column | str) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("bigint")


def weekday_label(weekday: Column | str) -> Column:
    """Label of a weekday number, Monday = 0; null outside 0..6."""
    number = F.col(weekday) if isinstance(weekday, str) else weekday
    return F.get(F.array(*[F.lit(label) for label in WEEKDAY_LABELS]), number)


def row_type_label(is_prediction: Column | str) -> Column:
    flag = F.col(is_prediction) if isinstance(is_prediction, str) else is_prediction
    return F.when(flag, F.lit(FORECAST_LABEL)).when(~flag, F.lit(ACTUAL_LABEL))


def station_label(name: Column | str, station: Column | str) -> Column:
    """The station's name, or the default label made from its id."""
    column = F.col(name) if isinstance(name, str) else name
    number = F.col(station) if isinstance(station, str) else station
    return F.coalesce(column, F.concat(F.lit(STATION_PREFIX), number.cast("string")))
