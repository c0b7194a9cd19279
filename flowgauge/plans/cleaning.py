"""Cleaning of raw swipes."""

from pyspark.sql import DataFrame

from flowgauge.operators.quality import dedup, drop_incomplete
from flowgauge.operators.rows import drop_columns
from flowgauge.sources.fixed_values import UNUSED_COLUMNS


def clean_swipes(df: DataFrame, unused: list[str] | None = None) -> DataFrame:
    """Drop unused columns, rows with a null and duplicate rows.

    Incomplete rows go first, so they are never shuffled; the rows that stay are the same either
    way. ``quality_audit`` of the frame without the unused columns counts what goes.
    """
    kept = drop_columns(df, UNUSED_COLUMNS if unused is None else unused)
    return dedup(drop_incomplete(kept))
