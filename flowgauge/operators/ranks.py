"""Values at given ranks of very long columns, found digit by digit."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.session import scratch_path

#: Bits of a key that one pass over the counted values settles.
DIGIT, BITS = 16, 64
_QUESTION = "column string, known int, prefix long, rank long"


def _ordered_bits(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; given such numbers as doubles' bits, it takes them back."""
    bits = values.view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def double_of_key(key: int) -> float:
    return float(_ordered_bits(np.array([key], np.int64)).view(np.float64)[0])


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("value").to_numpy(zero_copy_only=False) + 0.0
        yield pa.RecordBatch.from_arrays([batch.column("column"), pa.array(_ordered_bits(values)), *batch.columns[1:]], ["column", "key", "value", "times"])


def counted_values(df: DataFrame, whole: list[str], fractional: list[str]) -> DataFrame:
    """``column``, ``key``, ``value``, ``times``: how often each value stands in each column; written once.

    Keys are 64-bit whole numbers in the order of the values: whole columns' own, and of fractional ones the bits of the
    double. Nulls and NaN are left out. Equal values meet before the shuffle.
    """
    parts = []
    for columns, kind in ((whole, "bigint"), (fractional, "double")):
        if columns:
            values = df.select(*[F.col(c).cast(kind).alias(c) for c in columns]).unpivot([], columns, "column", "value")
            good = F.col("value").isNotNull() & (~F.isnan("value") if kind == "double" else F.lit(True))
            counted = values.where(good).groupBy("column", "value").agg(F.count(F.lit(1)).alias("times"))
            if kind == "double":
                parts.append(counted.mapInArrow(_with_keys, "column string, key long, value double, times long"))
            else:
                parts.append(counted.select("column", F.col("value").alias("key"), F.col("value").cast("double").alias("value"), "times"))
    counted = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
    path = scratch_path(df.sparkSession, "counted")
    counted.write.parquet(path)
    return df.sparkSession.read.schema(counted.schema).parquet(path)


def keys_at_ranks(counted: DataFrame, ends: dict[str, tuple[int, int]], ranks: dict[str, set[int]]) -> dict[tuple[str, int], int]:
    """The key of each (column, rank from 0), given each column's least and greatest key.

    Every pass counts the next ``DIGIT`` bits of the keys that share the leading bits known so far, of all columns and
    ranks at once, and keeps for each rank the bits whose count it falls into. Leading bits in which least and greatest
    key agree take no pass, so that small counts need one and any 64-bit keys four. A pass adds up at most 65,536
    counts in order for each rank; no value is held anywhere, and one row per rank reaches the driver.
    """
    spark = counted.sparkSession
    open_, found = {}, {}
    for column, wanted in ranks.items():
        least, greatest = ends[column]
        left = next(s for s in range(0, BITS + 1, DIGIT) if s == BITS or least >> s == greatest >> s)
        for rank in wanted:
            open_[column, rank] = (left, least >> left if left < BITS else 0, rank)
    while open_:
        found |= {k: prefix for k, (left, prefix, _) in open_.items() if not left}
        open_ = {k: v for k, v in open_.items() if v[0]}
        if not open_:
            break
        asked = sorted({(c, left, prefix, rest) for (c, _), (left, prefix, rest) in open_.items()})
        questions = spark.createDataFrame(asked, _QUESTION)
        places = F.broadcast(questions.select("column", "known", "prefix").distinct())
        same = (F.col("known") == BITS) | (F.expr("shiftright(key, known)") == F.col("prefix"))
        digits = counted.join(places, "column").where(same)
        digits = digits.groupBy("column", "known", "prefix", F.expr(f"shiftright(key, known - {DIGIT})").alias("next"))
        digits = digits.agg(F.sum("times").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("column", "known", "prefix").orderBy("next"))
        digits = digits.withColumn("upto", upto)
        hits = digits.join(F.broadcast(questions), ["column", "known", "prefix"])
        hits = hits.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        hits = hits.select("column", "known", "prefix", "rank", "next", (F.col("rank") - F.col("upto") + F.col("n")).alias("rest"))
        settled = {(r["column"], r["known"], r["prefix"], r["rank"]): (r["next"], r["rest"]) for r in hits.collect()}
        for (column, rank), (left, prefix, rest) in open_.items():
            following, remaining = settled[column, left, prefix, rest]
            open_[column, rank] = (left - DIGIT, following, remaining)
    return found
