"""Labelled rows to learn from: which rows may be learned from, and a bounded sample of them."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.turns import released


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """One row in five, by the CRC-32 of its id as text. A null id is held out, since it has no remainder."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, y) of at most ``per_class`` labelled documents of each class, held-out ones left out.

    Only ids that ``docs`` has count towards the bound. They are taken by a hash of the id, so the sample is the same in
    every run. Rows whose label is not 0 or 1 are passed over; an id labelled more than once takes its smallest label, and
    one that stands in several rows of ``docs`` gives one of them, that of the smallest hash of its text. The ids are broadcast:
    they are at most twice ``per_class``, as are the rows.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    one = [
        known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)
    ]
    ids = one[0].unionAll(one[1]).withColumnRenamed("doc_id", "_id")
    rows = docs.join(F.broadcast(ids), docs["doc_id"] == ids["_id"]).select("doc_id", "text", "y")
    text = F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text"), "text"))
    return rows.groupBy("doc_id", "y").agg(text.alias("text")).select("doc_id", "text", "y")


def scored(docs: DataFrame, score: Callable[[list], np.ndarray], columns: list[str]) -> DataFrame:
    """The given columns of every row, and ``score`` of its whole text: one pass, no shuffle."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score(_texts(batch)), pa.float64())], [*columns, "score"])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    return docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(add, ", ".join([*fields, "score double"]))


def kept_by_score(docs: DataFrame, score: Callable[[list], np.ndarray], keep: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """The rows, with all of their columns, whose score ``keep`` says yes to."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            yield batch.filter(pa.array(keep(score(_texts(batch))), pa.bool_()))

    return docs.mapInArrow(take, docs.schema)


def _texts(batch: pa.RecordBatch) -> list:
    return batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary()).to_pylist()
