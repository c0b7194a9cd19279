"""Token ids in ORC files, in the order of document ids, and reading them back."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgauge.llm.encoding import encoder, is_joined, some_texts
from flowgauge.llm.tables import stored
from flowgauge.llm.turns import released

#: ORC packs integers by run-length encoding (version 2), after which a compressor finds little; these set stripes, indexes
#: and filters.
ORC_OPTIONS = {
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "2000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "none",
}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write (doc_id, row, ids) of ``docs`` (doc_id, text) as ORC files in ascending order of doc_id.

    The ids are those of the whole text and ``end_id``; null and empty texts are the end alone. Null ids come first;
    repeated ids stand together, ordered by text. Texts are dealt by ranges of doc_id and sorted, then encoded in place:
    token arrays are never shuffled. Files are numbered in order, and ``row`` grows along the files. Each stripe has its
    ids run-length encoded, an index entry per 2,000 rows, and a Bloom filter on doc_id.
    """
    joined = is_joined(tokenizer)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        encode = encoder(tokenizer, joined).encode
        for whole in released(batches):
            for batch in some_texts(whole):
                coded = [ids + end for ids in encode([t or "" for t in batch.column("text").to_pylist()])]
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
                flat = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = read.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    coded = ranged.mapInArrow(code, "doc_id long, ids array<int>")
    coded = coded.select("doc_id", F.monotonically_increasing_id().alias("row"), "ids")
    coded.write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, row, ids; of the given documents alone, which file, stripe and Bloom filter metadata narrow down."""
    rows = spark.read.schema("doc_id long, row long, ids array<int>").orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat, ends = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())],
            ["doc_id", "row", "n_tokens", "ids_crc32"],
        )


def token_index(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of ``read_tokens``: what the files hold and where.

    ``start`` counts the ids of all documents before this one. The files are read once. Rows are summed by the part that wrote them, and the
    parts' totals, one row each, are added up in order.
    """
    counted = stored(tokens.mapInArrow(_sums, "doc_id long, row long, n_tokens long, ids_crc32 long"), "counts")
    counted = counted.withColumn("part", F.shiftright("row", 33))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("part").alias("of"), F.coalesce(F.sum("all").over(before), F.lit(0)).alias("before"))
    placed = counted.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    joined = placed.join(totals, F.col("part") == F.col("of"))
    return joined.select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
