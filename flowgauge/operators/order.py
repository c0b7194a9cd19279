"""Row numbers and row windows over one long order, without gathering it in one task."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.session import scratch_path

#: Bits of monotonically_increasing_id below the partition number.
PART_BITS = 33
#: Rows of a block that one task takes through a window.
BLOCK = 1 << 20


def with_row_number(df: DataFrame, order: list[str | Column], name: str = "row_number") -> DataFrame:
    """Add each row's number (from 1) in a global order.

    Rows are dealt by ranges of the order and sorted within them; a row's number is its place in its range plus the rows of
    the ranges before. The sorted table is written once; besides it only one total per range is added up. Rows that
    tie in the whole order are numbered in any way.
    """
    spark = df.sparkSession
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("_id", F.monotonically_increasing_id())
    path = scratch_path(spark, "ordered")
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path).withColumn("_part", F.shiftright("_id", PART_BITS))
    totals = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per range: as many as the session has shuffle partitions.
    totals = F.broadcast(totals.select(F.col("_part").alias("_of"), before.alias("_before")))
    place = F.col("_id").bitwiseAND((1 << PART_BITS) - 1) + F.col("_before") + 1
    return rows.join(totals, F.col("_part") == F.col("_of")).select(*df.columns, place.cast("bigint").alias(name))


def over_long_order(
    df: DataFrame, order: list[str | Column], halo: int, columns: Callable[[Window], dict[str, Column]], block: int | None = None
) -> DataFrame:
    """Add columns of a window that looks back at most ``halo`` rows in a global order.

    Numbered rows are cut into blocks; each block also gets the last ``halo`` rows of the one before, which are dropped
    once the window has seen them. A block of rows is a task's work, however long the order.
    """
    block = max(block or BLOCK, halo, 1)
    numbered = with_row_number(df, order, "_place")
    own = F.floor((F.col("_place") - 1) / block)
    left = block - (F.col("_place") - 1) % block  # rows of the block from this one on
    homes = F.when(left <= halo, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.withColumn("_own", own).withColumn("_block", F.explode(homes))
    window = Window.partitionBy("_block").orderBy("_place")
    return spread.withColumns(columns(window)).where("_block = _own").drop("_place", "_own", "_block")
