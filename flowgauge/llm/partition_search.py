"""Approximate nearest neighbours by learned partitions."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.partition_router import NEIGHBOURS, Router, balanced_parts, nearest_rows, part_shares
from flowgauge.llm.tables import stored

#: Vectors, at most, on which the parts and the classifier are fitted; rows for each part, and parts at most.
SAMPLE, ROWS_PER_PART, MOST_PARTS = 16_384, 512, 256
#: One sample vector in so many is kept out of the fit, to find how many parts a query must visit for the recall.
HELD_OUT, RECALL = 5, 0.95
#: Rows and queries of a task, and queries whose distances it holds at once.
CHUNK, SIDE, AT_ONCE = 8_192, 8_192, 256
#: Distances by products may be off by this share of the squared norms; whatever is that near is taken again exactly.
SLACK = 1e-9


class Index(NamedTuple):
    """``rows``: row, vec_id, x, part. Queries visit parts in order of probability until ``enough`` of it is covered."""

    rows: DataFrame
    parts: int
    enough: float
    router: Router | None


def _matrix(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    x = batch.column("x")
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return x.flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)


def fit_parts(sample: np.ndarray, parts: int, recall: float, seed: int) -> tuple[Router, float]:
    """A classifier of ``parts`` parts, and the probability that a query's parts must cover to reach the recall.

    Sample vectors are linked with their nearest ones, the graph is cut into equal parts with few links between them, and
    the classifier learns to tell from a vector its own part and those of its neighbours. Held-out vectors show how
    much probability comes before the parts that hold their neighbours.
    """
    out = np.arange(len(sample)) % HELD_OUT == 0
    x = sample[~out]
    neighbours = nearest_rows(x, x, NEIGHBOURS, np.arange(len(x)))
    part = balanced_parts(neighbours, parts, seed)
    targets = 0.5 * part_shares(neighbours, part, parts) + 0.5 * np.eye(parts)[part]
    router = Router(x, targets, seed)
    home = router(sample).argmax(axis=1)
    asked = np.nonzero(out)[0]
    near = nearest_rows(sample, sample[asked], NEIGHBOURS, asked)
    chances = router(sample[asked])
    order = np.argsort(-chances, axis=1, kind="stable")
    before = np.take_along_axis(chances, order, 1).cumsum(axis=1) - np.take_along_axis(chances, order, 1)
    place = np.argsort(order, axis=1)
    needed = np.take_along_axis(before, np.take_along_axis(place, home[near], 1), 1)
    return router, float(np.quantile(needed, recall, method="higher"))


def _homes(router: Router | None):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = router(_matrix(batch)).argmax(axis=1) if router else np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], [*batch.schema.names, "part"])

    return assign


def _routes(router: Router | None, parts: int, enough: float):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if router is None:
                visits = [list(range(parts))] * batch.num_rows
            else:
                chances = router(_matrix(batch))
                order = np.argsort(-chances, axis=1, kind="stable")
                ranked = np.take_along_axis(chances, order, 1)
                taken = ranked.cumsum(axis=1) - ranked <= enough
                visits = [o[t].tolist() for o, t in zip(order, taken, strict=True)]
            names = [*batch.schema.names, "visits"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(visits, pa.list_(pa.int32()))], names)

    return route


def nearest_in(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, vector, distance) of each query's ``k`` nearest rows of a chunk, ties to the smaller id; own rows left out."""
    with np.errstate(over="ignore", invalid="ignore"):
        norms = (x * x).sum(axis=1)
        for start in range(0, len(queries), AT_ONCE):
            some = queries[start : start + AT_ONCE]
            far = norms - 2 * some @ x.T
            for query, q, row in zip(query_ids[start : start + AT_ONCE].tolist(), some, far, strict=True):
                at = np.nonzero(ids != query)[0] if (ids == query).any() else None
                row = row if at is None else row[at]
                if len(row) > k:
                    margin = SLACK * (norms.max() + q @ q)
                    near = np.nonzero(~(row > np.partition(row, k - 1)[k - 1] + margin))[0]
                else:
                    near = np.arange(len(row))
                near = near if at is None else at[near]
                exact = np.sqrt(((x[near] - q) ** 2).sum(axis=1))
                for i in np.lexsort((ids[near], exact))[:k].tolist():
                    yield query, int(ids[near[i]]), float(exact[i])


def _searcher(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        if asks.all() or not asks.any():
            return schema.empty_table()
        ids, x = table.column("vec_id").to_numpy(), _matrix(table)
        found = list(nearest_in(ids[~asks], x[~asks], ids[asks], x[asks], k))
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return search


def build_index(rows: DataFrame, n: int, recall: float = RECALL, seed: int = 13) -> Index:
    """The part of every one of ``n`` rows (row, vec_id, x; vectors of one length), fitted on a sample by row number."""
    parts = 1
    while 2 * parts * ROWS_PER_PART <= n and parts < MOST_PARTS:
        parts *= 2
    router, enough = None, 1.0
    if parts > 1:
        cells = 1 << 40
        drawn = rows.where(F.pmod(F.xxhash64("row"), F.lit(cells)) <= int(min(1.0, SAMPLE / n) * cells))
        sample = _matrix(drawn.select("row", "x").toArrow().sort_by("row"))
        # Copies would be neighbours of none but each other.
        sample = np.unique(sample, axis=0)
        sample = sample[np.random.default_rng(seed).permutation(len(sample))[:SAMPLE]]
        if len(sample) < 16 * parts:  # mostly copies: fewer parts, as there are fewer vectors
            parts = 1 << max(0, len(sample) // 16).bit_length() >> 1 or 1
        if parts > 1:
            router, enough = fit_parts(sample, parts, recall, seed)
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType())])
    return Index(stored(rows.mapInArrow(_homes(router), schema), "parts"), parts, enough, router)


def _per_part(counts: DataFrame, parts: int, size: int) -> list[int]:
    """How many pieces of at most some ``size`` rows each part is dealt to; a row per part reaches the driver."""
    found = dict(counts.groupBy("part").count().collect())
    return [max(1, -(-found.get(p, 0) // size)) for p in range(parts)]


def search_index(index: Index, asked: DataFrame, k: int, everywhere: bool = False) -> DataFrame:
    """query_id, vec_id, score of the ``k`` nearest of every query (vec_id, x) in the parts it is routed to, or in all.

    A part is dealt to chunks of rows, and its queries to sides; a task takes one chunk and one side and returns at most k
    rows a query.
    """
    schema = T.StructType([*asked.schema.fields, T.StructField("visits", T.ArrayType(T.IntegerType()))])
    router = None if everywhere else index.router
    routed = asked.mapInArrow(_routes(router, index.parts, index.enough), schema)
    routed = stored(routed.select("vec_id", "x", F.explode("visits").alias("part")), "routed")
    chunks, sides = _per_part(index.rows, index.parts, CHUNK), _per_part(routed, index.parts, SIDE)

    def of(part_counts: list[int]) -> Column:
        return F.element_at(F.array(*map(F.lit, part_counts)), F.col("part") + 1)

    def every(part_counts: list[int]) -> Column:
        return F.explode(F.sequence(F.lit(0), of(part_counts) - 1))

    own_chunk = F.pmod(F.xxhash64("row"), of(chunks)).cast("int").alias("chunk")
    own_side = F.pmod(F.xxhash64("vec_id"), of(sides)).cast("int").alias("side")
    columns = ["vec_id", "x", "asks", "part", "chunk", "side"]
    rows = index.rows.select("vec_id", "x", F.lit(False).alias("asks"), "part", own_chunk, every(sides).alias("side"))
    queries = routed.select("vec_id", "x", F.lit(True).alias("asks"), "part", own_side, every(chunks).alias("chunk"))
    grid = rows.select(columns).unionAll(queries.select(columns)).groupBy("part", "chunk", "side")
    found = grid.applyInArrow(_searcher(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, recall: float = RECALL, embedding: str = "embedding", seed: int = 13
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the ``k`` nearest others that its parts hold, by Euclidean distance.

    ``vectors`` has vec_id and an array of numbers; other columns are not read but by ``is_query``. Distances are taken in
    double precision from the vectors as they are; ties go to the smaller vec_id. Vectors that are null, empty, zero or
    hold null or non-finite components take no part, nor do rows with a null vec_id. Vectors are only compared with others
    of their length; each length has an index of its own. Rows that repeat a vec_id are all candidates; as queries
    they are one, by their smallest vector. A query whose parts hold fewer than ``k`` others is asked of all parts. An
    empty table, or one without queries, gives an empty one.

    The parts and the classifier that routes to them are fitted on at most ``SAMPLE`` vectors, drawn by a hash; every row is
    indexed. Held-out sample vectors set how far down the list of probable parts a query goes for ``recall``. Tables of less than
    twice ``ROWS_PER_PART`` rows are one part and searched in full.
    """
    element = vectors.schema[embedding].dataType
    single = isinstance(element, T.ArrayType) and isinstance(element.elementType, T.FloatType)
    x = F.col(embedding).cast("array<float>" if single else "array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), is_query.alias("asks"), good.alias("good"))
    rows = rows.where("vec_id is not null and good").withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows.select("row", "vec_id", "x", "asks", F.size("x").alias("width")), "vectors")
    found = []
    for width, n in sorted(rows.groupBy("width").count().collect()):
        same = rows.where(F.col("width") == width)
        asked = stored(same.where("asks").groupBy("vec_id").agg(F.min("x").alias("x")), "queries")
        index = build_index(same.select("row", "vec_id", "x"), n, recall, seed)
        near = search_index(index, asked, k)
        if index.parts > 1:
            near = stored(near, "found")
            full = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
            short = stored(asked.join(full, "vec_id", "left_anti"), "short")
            if not short.isEmpty():
                again = short.select(F.col("vec_id").alias("query_id"))
                near = near.join(again, "query_id", "left_anti").unionByName(search_index(index, short, k, everywhere=True))
        found.append(near)
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
