"""Train/test splits and folds that give the same rows at any partitioning."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.session import scratch_path

#: Deviations around the expected place of the last test row within which its digest is looked for at once.
SPREADS = 6
#: Digits of a digest that tell whether its row is near the last test row.
LEAD = 15


def _digest(keys: list[str], seed: int) -> Column:
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def split_exact(
    df: DataFrame, keys: list[str], test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, the test side of exactly ``ceil(test_share * rows)`` rows.

    ``keys`` identify a row. Rows are taken in the order of a digest of their keys. The table
    is never sorted as a whole: one pass makes the digests and writes each row with its side, the few rows
    near the place where the last test row is due are ranked, and only they are compared with its
    digest. ``df`` is counted before.
    """
    flagged = with_test_flag(df, keys, test_share, seed)
    return flagged.where(~F.col("is_test")).drop("is_test"), flagged.where("is_test").drop("is_test")


def _edge(digests: DataFrame, digits: Column, wanted: Column) -> Column:
    """The group of equal ``digits`` that holds the ``wanted``-th digest, and its rank there: a one-row subquery.

    ``wanted`` is a column of ``digests`` that is the same in all rows. At most 65,536 counts are
    added up in order.
    """
    counts = digests.groupBy(digits.alias("span")).agg(F.count(F.lit(1)).alias("n"), F.first(wanted).alias("wanted"))
    upto = F.sum("n").over(Window.orderBy("span"))
    reached = counts.withColumn("upto", upto).where(F.col("upto") >= F.col("wanted"))
    rank = F.col("wanted") - (F.col("upto") - F.col("n"))
    return reached.agg(F.min_by(F.struct("span", rank.alias("rank")), F.col("span")).alias("edge")).scalar()


def with_test_flag(df: DataFrame, keys: list[str], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``, see :func:`split_exact`. Counts ``df`` and runs one pass over it at once; the result is what that wrote.

    Digests are even draws, so that the last test row is all but certain to lie within ``SPREADS`` deviations of where it is
    due: rows outside that stretch are settled when they are written. The stretch holds some 2 * SPREADS * sqrt(n / 4) rows,
    whose digests are made again. Where the row is not there, as with keys that repeat a lot, it is sought by counting digits.
    """
    spark, digest = df.sparkSession, _digest(keys, seed)
    n = df.count()
    wanted = math.ceil(n * test_share)
    if not wanted:
        return df.withColumn("is_test", F.lit(False))
    due, off = wanted / n, SPREADS * math.sqrt(wanted * (n - wanted) + n) / n**1.5
    low, high = (f"{round(min(max(x, 0.0), 1.0) * (16**LEAD - 1)):0{LEAD}x}" for x in (due - off, due + off))
    hashed = df.withColumn("_lead", F.substring(digest, 1, LEAD))
    sided = hashed.withColumn("_test", F.when(F.col("_lead") < low, True).when(F.col("_lead") > high, False)).drop("_lead")
    path = scratch_path(spark, "sides")
    sided.write.parquet(path)
    sided = spark.read.schema(sided.schema).parquet(path)
    last, found = _last_test_row(sided, keys, digest, wanted)
    near = F.coalesce(F.struct(digest.alias("_digest"), *keys) <= last, F.lit(False))
    is_test = F.coalesce(F.col("_test"), near) if found else near
    return sided.withColumn("is_test", is_test).drop("_test")


def _last_test_row(sided: DataFrame, keys: list[str], digest: Column, wanted: int) -> tuple[Column, bool]:
    """The ``wanted``-th row in the order of digest and keys, as a one-row subquery; and whether it is among those without a side."""
    place = F.struct(digest.alias("_digest"), *keys)
    before = sided.where("_test").count()
    near = sided.where("_test is null").groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("times"))
    path = scratch_path(sided.sparkSession, "digests")
    near.write.parquet(path)
    near = sided.sparkSession.read.schema(near.schema).parquet(path)
    inside = near.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    if not before < wanted <= before + inside:
        digests = sided.select(digest.alias("_digest"), *keys)
        return _sought_test_row(digests, F.struct("_digest", *keys), wanted), False
    upto = F.sum("times").over(Window.orderBy("place"))
    reached = near.withColumn("upto", upto).where(F.col("upto") >= wanted - before)
    return reached.agg(F.min("place").alias("last")).scalar(), True


def _sought_test_row(digests: DataFrame, place: Column, wanted: int) -> Column:
    """The ``wanted``-th row whatever the digests: by 65,536 ranges, the same number of parts of one range, and ranks in one part."""
    high, low = F.substring("_digest", 1, 4), F.substring("_digest", 5, 4)
    first = _edge(digests.withColumn("_wanted", F.lit(wanted).cast("bigint")), high, F.col("_wanted"))
    inside = digests.withColumn("_edge", first).where(high == F.col("_edge.span"))
    second = _edge(inside, low, F.col("_edge.rank"))
    ranked = (
        inside.withColumn("_low", second)
        .where(low == F.col("_low.span"))
        .select(place.alias("place"), F.col("_low.rank").alias("wanted"))
        .withColumn("rank", F.row_number().over(Window.orderBy("place")))
    )
    return ranked.where(F.col("rank") == F.col("wanted")).select("place").scalar()


def with_time_test_flag(df: DataFrame, time: str, test_share: float = 0.2) -> DataFrame:
    """Add ``is_test`` to the latest rows: from the first time on that leaves at most ``test_share`` of the rows.

    Rows are counted by time, so all rows of a time are on one side. One row per slot goes
    through the running sum, however many stations there are.
    """
    counts = df.groupBy(time).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    rest = F.sum("n").over(Window.orderBy(F.col(time).desc()))
    late = counts.select(time, (rest <= total * F.lit(test_share)).alias("late")).where("late")
    first = late.agg(F.min(time).alias("first")).scalar()
    return df.withColumn("is_test", F.coalesce(F.col(time) >= first, F.lit(False)))


def split_hash(
    df: DataFrame, keys: list[str], test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a threshold on a digest of the keys: one pass, test share only about right."""
    drawn = F.substring(_digest(keys, seed), 1, 8) < F.lit(f"{round(test_share * 2**32):08x}")
    return df.where(~drawn), df.where(drawn)


def contiguous_folds(df: DataFrame, order: str, k: int = 5, name: str = "fold") -> DataFrame:
    """Number the rows 0..k-1 in contiguous blocks of the ordered distinct ``order`` values.

    Blocks are as even as possible, larger ones first. ``order`` is a date: the blocks are
    made on the calendar, which is small, and joined back.
    """
    days = df.select(order).distinct()
    block = F.ntile(k).over(Window.orderBy(order)) - 1
    return df.join(days.withColumn(name, block.cast("int")), order)
