"""Small helpers on tables: stages written to the shared folder, places within ordered groups, running sums."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgauge.session import scratch_path

#: Bits of monotonically_increasing_id below the partition number.
PART_BITS = 33


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table after a trip through the shared folder: lost executors don't undo it, and its plan is a scan."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_place(df: DataFrame, group: list[str], order: list, name: str, amount: str | None = None) -> DataFrame:
    """Each row's place (from 0) within its group in an order, or the sum of ``amount`` over the rows before it.

    No group is gathered: rows are dealt by ranges of (group, order), counted or summed by range, and the ranges'
    totals (one row per range and group) are added up. A group of any size spans as many ranges as it fills. Rows that
    tie in the whole order are interchangeable in their place. ``df`` should be narrow; it is written once.
    """
    ranged = df.repartitionByRange(*[F.col(g) for g in group], *order).sortWithinPartitions(
        *[F.col(g) for g in group], *order
    )
    rows = stored(ranged.withColumn("_row", F.monotonically_increasing_id()), "ranges")
    rows = rows.withColumn("_part", F.shiftright("_row", PART_BITS))
    value = F.lit(1).cast("long") if amount is None else F.col(amount)
    totals = rows.groupBy(*group, "_part").agg(F.sum(value).alias("_sum"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    totals = totals.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_part").alias("_of"), "_before", "_first")
    on = F.col("_part") == F.col("_of")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    if amount is None:
        joined = rows.join(totals, on)
        place = F.col("_before") + F.col("_row") - F.col("_first")
    else:
        inside = Window.partitionBy(*group, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        joined = rows.join(totals, on)
        place = F.col("_before") + F.col("_inside")
    return joined.select(*df.columns, place.cast("long").alias(name))
