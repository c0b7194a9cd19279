"""The daily report: actual days and forecast days in one formatted table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.numfns import row_type_label, thousands, weekday_label
from flowgauge.functions.timefns import date_text
from flowgauge.operators.flow import union_all
from flowgauge.sources.fixed_values import REPORT_COLUMNS


def build_report(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Text columns: date, weekday label, entries, exits with thousands separators, row type.

    Either table may have columns that the other lacks.
    """
    rows = union_all([actual.withColumn("isPrediction", F.lit(False)), forecast])
    texts = [
        date_text("date"),
        weekday_label("dayOfWeek"),
        thousands("inNums"),
        thousands("outNums"),
        row_type_label("isPrediction"),
    ]
    return rows.select(*[text.alias(name) for text, name in zip(texts, REPORT_COLUMNS)])
