"""Near-duplicate vectors by random hyperplanes, exact cosines and connected components."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.components import components
from flowgauge.llm.tables import stored

#: Vectors that a table's bucket should hold on average, and vectors of one half of a comparison.
BUCKET, CHUNK = 256, 1_024
LEAST_BITS, MOST_BITS = 8, 30
#: A pair of just the threshold's cosine may share no bucket with this chance.
MISS = 0.002


def tables_and_bits(n: int, cosine: float, miss: float = MISS) -> tuple[int, int]:
    """How many tables of how many hyperplanes: buckets stay small as ``n`` grows, and so does the chance of a miss.

    Vectors at angle a fall on one side of a random hyperplane with chance 1 - a / pi.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, n) / BUCKET))))
    one_table = (1 - math.acos(cosine) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log1p(-one_table))), bits


def _planes(width: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).standard_normal((width, tables * bits))


def _codes(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """One integer per vector and table: the signs of its products with the table's hyperplanes."""
    signs = vectors @ _planes(vectors.shape[1], tables, bits, seed) > 0
    return signs.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _signer(tables: int, bits: int, seed: int, kind: str):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, widths = batch.column("raw").to_pylist(), batch.column("width").to_numpy()
            codes = np.empty((len(raw), tables), np.int64)
            for width in np.unique(widths):
                at = np.nonzero(widths == width)[0]
                x = np.frombuffer(b"".join(raw[i] for i in at), kind).reshape(len(at), width).astype(np.float64)
                codes[at] = _codes(x, tables, bits, seed)
            flat = pa.array(codes.reshape(-1).astype(np.int32))
            ends = pa.array(np.arange(0, tables * len(raw) + 1, tables, dtype=np.int32))
            arrays = [batch.column(c) for c in ("number", "copies", "width", "raw")]
            names = ["number", "copies", "width", "raw", "codes"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(ends, flat)], names)

    return sign


def _packer(kind: str):
    """Vectors as bytes; rows that take no part as null."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("vector"):
                x = None if not v.is_valid or v.values.null_count else v.values.to_numpy(zero_copy_only=False).astype(kind)
                good = x is not None and len(x) and np.isfinite(x).all() and x.any()
                # Minus zero is zero.
                out.append((x + np.array(0, kind)).tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "raw"])

    return pack


def bucket_links(
    ids: np.ndarray, copies: np.ndarray, x: np.ndarray, codes: np.ndarray, side: np.ndarray, table: int, cosine: float
) -> list[tuple[int, int, int]]:
    """(vector, a vector that it is connected with, copies of the vectors that it links with) within one bucket.

    Every pair is compared, by blocked products of unit vectors; with both sides present, only pairs across them. A pair
    that an earlier table brings together too is left to that one, so that every link counts once.
    """
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    if side.any() and not side.all():
        rows, columns = np.nonzero(~side)[0], np.nonzero(side)[0]
        i, j = np.nonzero(unit[rows] @ unit[columns].T >= cosine)
        i, j = rows[i], columns[j]
    else:
        i, j = np.nonzero(np.triu(unit @ unit.T >= cosine, 1))
    if table and len(i):
        new = ~(codes[i, :table] == codes[j, :table]).any(axis=1)
        i, j = i[new], j[new]
    if not len(i):
        return []
    links = np.bincount(i, copies[j], minlength=len(ids)) + np.bincount(j, copies[i], minlength=len(ids))
    label = np.arange(len(ids))
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            break
    return [(int(ids[v]), int(ids[label[v]]), int(links[v])) for v in np.nonzero(links)[0]]


def _linker(cosine: float, kind: str):
    def link(table: pa.Table) -> pa.Table:
        n, width, number = table.num_rows, table.column("width")[0].as_py(), table.column("table")[0].as_py()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        side = table.column("chunk").to_numpy() != low
        if n < 2 or low != high and (side.all() or not side.any()):
            found = []
        else:
            x = np.frombuffer(b"".join(table.column("raw").to_pylist()), kind).reshape(n, width).astype(np.float64)
            codes = table.column("codes").combine_chunks().flatten().to_numpy().reshape(n, -1)
            copies = table.column("copies").to_numpy()
            found = bucket_links(table.column("number").to_numpy(), copies, x, codes, side, number, cosine)
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("a", "b", "links"), columns, strict=True)})

    return link


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.9, seed: int = 11, embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id and an array of numbers).

    * Pairs of vectors of one length with a cosine of ``cosine`` or more, in double precision, are linked if some table
      brings them together; see ``tables_and_bits`` for the chance of that. No pair below the threshold is linked.
    * n_links counts the other rows linked directly, component_id is the smallest vec_id reachable, itself included, and
      kept marks the row that has it.
    * Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows with a null
      vec_id (component null, kept). Rows that repeat a vec_id are rows of their own that share its component.

    Equal vectors are one class, counted once with their number. A bucket of more than ``CHUNK`` classes is dealt to chunks
    and its cells are pairs of chunks: tasks stay small and every pair of a bucket is compared. Cells return one row per
    vector, not the pairs.
    """
    element = vectors.schema[embedding].dataType
    single = isinstance(element, T.ArrayType) and isinstance(element.elementType, T.FloatType)
    kind, cast = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(embedding).cast(cast).alias("vector"))
    packed = stored(read.mapInArrow(_packer(kind), "vec_id long, raw binary"), "vectors")
    good = packed.where("raw is not null and vec_id is not null")
    classes = good.groupBy("raw").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    # A vec_id that repeats can be the smallest of several classes, so each has a number of its own.
    classes = classes.withColumns(
        {"width": (F.octet_length("raw") / int(kind[-1])).cast("int"), "number": F.monotonically_increasing_id()}
    )
    classes = stored(classes, "classes")
    tables, bits = tables_and_bits(classes.count(), cosine)
    coded = classes.mapInArrow(
        _signer(tables, bits, seed, kind), "number long, copies long, width int, raw binary, codes array<int>"
    )
    coded = stored(coded, "codes")
    keys = coded.select("width", F.posexplode("codes").alias("table", "code"))
    buckets = keys.groupBy("width", "table", "code").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"), F.count("*").alias("n"))
    buckets = buckets.where("n > 1").drop("n")
    members = coded.select("*", F.posexplode("codes").alias("table", "code")).join(buckets, ["width", "table", "code"])
    members = members.withColumn("chunk", F.pmod(F.xxhash64("raw"), F.col("chunks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    cells = members.withColumn("other", other).withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    cells = cells.select("width", "table", "code", "low", "high", "chunk", "number", "copies", "raw", "codes")
    found = cells.groupBy("width", "table", "code", "low", "high").applyInArrow(_linker(cosine, kind), "a long, b long, links long")
    found = stored(found, "links")
    linked = found.groupBy("a").agg(F.sum("links").alias("links"))
    of_class = classes.select("raw", "number", "rep", "copies").join(linked, classes.number == linked.a, "left")
    a, b = (classes.select(F.col("number").alias(c), F.col("rep").alias(f"rep_{c}")) for c in "ab")
    pairs = found.join(a, "a").join(b, "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    several = good.groupBy("vec_id").agg(F.min("raw").alias("p"), F.max("raw").alias("q")).where("p <> q").select(F.col("vec_id").alias("a"))
    several = good.join(several, good.vec_id == several.a).join(classes.select(F.col("raw").alias("of"), "rep"), F.col("raw") == F.col("of"))
    roots = components(pairs.unionAll(several.select("a", F.col("rep").alias("b"))), "a", "b")
    of_class = of_class.join(roots, of_class.rep == roots.node, "left").select(
        F.col("raw").alias("of"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "rep").alias("component_id"),
    )
    marked = good.join(of_class, F.col("raw") == F.col("of")).select("vec_id", "n_links", "component_id")
    alone = packed.where("raw is null or vec_id is null")
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return marked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
