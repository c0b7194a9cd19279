"""Vectors as short codes: product quantisation in integers."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.gnat import Gnat
from flowgauge.llm.tables import stored
from flowgauge.llm.threshold_search import integer_parts

#: Vectors that a task codes at once.
AT_ONCE = 4_096
#: A label with more than one row in this many is sent to all executors; there are fewer such labels than this.
FREQUENT = 1_000


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            some = batch.slice(start, AT_ONCE)
            yield some, some.column("x").flatten().to_numpy().reshape(-1, width)


def _nearest(trees: list[Gnat], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances of all parts, a column per part."""
    cuts = np.split(x, len(trees), axis=1)
    found = [tree.nearest(part) for tree, part in zip(trees, cuts, strict=True)]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _adder(books: np.ndarray):
    """Sums and numbers of a task's parts by the codebook entry that they are nearest to."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books]
        sums, counts = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for _, x in _blocks(batches, parts * width):
            codes, _ = _nearest(trees, x)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], x[:, p * width : (p + 1) * width])
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        columns = [np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p))]
        columns += [np.repeat(counts[p, e], width), sums[p, e].reshape(-1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "n", "total"])

    return add


def _coder(books: np.ndarray):
    parts, _, width = books.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books]
        for some, x in _blocks(batches, parts * width):
            codes, errors = _nearest(trees, x)
            text, step = codes.astype("u1").tobytes().hex(), 2 * parts
            written = [text[i : i + step] for i in range(0, len(text), step)]
            arrays = [some.column("vec_id"), some.column("label"), pa.array(written, pa.string()), pa.array(errors.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "code", "error"])

    return code


def fit_codebooks(rows: DataFrame, parts: int, entries: int, rounds: int, width: int) -> np.ndarray:
    """Codebooks (part, entry, component) from rows (vec_id, x): first rows' parts, moved to their parts' means each round.

    What reaches the driver are the first ``entries`` rows and one row per component of the codebooks and round.
    """
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = rows.select("x").mapInArrow(_adder(books), "part long, entry long, place long, n long, total long")
        sums = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        for part, entry, place, n, total in sums.collect():
            books[part, entry, place] = total // n
    return books


def code_vectors(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that can be coded.

    Components become floor(scale * x), vectors are cut into ``parts`` equal parts, and each part is written as the index
    of its codebook's nearest entry, two hex digits each; ties go to the lower index. Codebooks begin with the parts of the
    rows of the ``entries`` smallest vec_ids (ties by vector, null ids last; all rows if fewer); in each round all parts are
    assigned and every entry becomes the floor of its parts' mean, or stays if it has none. error is the sum of the squared
    distances, label_error its sum over all rows of equal label, null included; the digest is of all final components.

    Vectors that are null, empty or hold null or non-finite components are left out; a null vec_id is kept. Rows that
    repeat are coded each. An empty table gives an empty one. ValueError if vectors differ in length, the length can't be
    cut into equal parts, or components are so large that squared distances don't fit into 63 bits.

    Nearest entries are found with a tree over each codebook (``gnat.Gnat``). Rows are never shuffled but for the label sums:
    labels with more than a thousandth of all rows, at most 1,000, are sent to the rows; the others are joined.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits tell up to 256 entries")
    kind = vectors.schema[label].dataType
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(label).alias("label"), integer_parts(embedding, scale).alias("x")
    )
    rows = stored(rows.where(F.size("x") > 0), "integers")
    size, most = F.size("x"), F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))
    n, least, width, most = rows.agg(F.count("*"), F.min(size), F.max(size), F.max(most)).first()
    if not n:
        empty = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    if least != width or width % parts:
        raise ValueError(f"vectors of {least} to {width} components can't be cut into {parts} equal parts")
    if width * (2 * (most + 1)) ** 2 * entries >= 1 << 63:
        raise ValueError(f"components of up to {most} are too large for exact squared distances")
    books = fit_codebooks(rows, parts, entries, rounds, width // parts)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    fields = [("vec_id", T.LongType()), ("label", kind), ("code", T.StringType()), ("error", T.LongType())]
    coded = stored(rows.mapInArrow(_coder(books), T.StructType([T.StructField(*f) for f in fields])), "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    sums = stored(sums.withColumn("frequent", F.col("n") * FREQUENT > n).drop("n"), "labels")
    frequent, others = F.broadcast(sums.where("frequent")), sums.where("not frequent")
    same = F.col("label").eqNullSafe(F.col("of"))
    joined = coded.join(frequent, same).unionByName(coded.join(frequent, same, "left_anti").join(others, same))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
