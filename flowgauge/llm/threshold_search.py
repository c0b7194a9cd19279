"""Exact top-k by inner product with Fagin's threshold algorithm."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.tables import stored, with_place

#: Vectors of a block, and queries that a task takes through it.
BLOCK, QUERIES = 8_192, 8_192
#: Ranks of every list that are read before a query knows a k-th score.
FIRST_DEPTH = 16


class TopK(NamedTuple):
    """``rows``: query_id, rank, vec_id, score. ``work``: query_id, scored (vectors scored), blocks (of vectors looked into)."""

    rows: DataFrame
    work: DataFrame


def integer_parts(embedding: str, scale: int = 64) -> Column:
    """floor(scale * x) of every component, x as double; null if the vector is null or a component isn't finite."""
    whole = F.col(embedding).cast("array<double>")
    good = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(whole, lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


class SortedLists:
    """A block's vectors, and for every dimension their order by that component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        ordered = np.take_along_axis(vectors.T, self.order, 1)
        # Ranks at which reading may stop, and what stands there, from either end.
        n = len(ids)
        self.depths = np.unique(np.minimum(n, [0, *(int(2 ** (j / 2)) for j in range(2, 2 * n.bit_length() + 1))]))
        self.first = min(int(np.searchsorted(self.depths, FIRST_DEPTH)), len(self.depths) - 1)
        at = np.maximum(self.depths, 1)
        self.high, self.low = ordered[:, n - at], ordered[:, at - 1]
        self.steep = [self._steepness(side) for side in (self.high, -self.low)]

    def _steepness(self, values: np.ndarray) -> np.ndarray:
        """How much the values fall for each rank from a stop on, at best over any number of stops, and never more than before."""
        ranks = (self.depths[None, :] - self.depths[:, None]).astype(float)
        ranks[ranks <= 0] = np.inf
        best = [((v[:, None] - v[None, :]) / ranks).max(axis=1)[:-1] for v in values.astype(float)]
        return np.minimum.accumulate(np.array(best), axis=1)

    def values(self, w: np.ndarray) -> np.ndarray:
        """Weighted components by list and stop: what no vector that the list hasn't shown yet is above."""
        return np.where(w[:, None] > 0, self.high * w[:, None], self.low * w[:, None])

    def stops_below(self, w: np.ndarray, values: np.ndarray, floor: float) -> np.ndarray:
        """How many stops to go down each list until the values there add up to less than ``floor``, or all.

        Where the sum falls most for each rank read, be it over several stops, it is lowered first.
        """
        falls = values[:, :-1] - values[:, 1:]
        steep = np.where(w[:, None] > 0, *self.steep) * np.abs(w)[:, None]
        steps = np.argsort(-steep, axis=None, kind="stable")
        # Room for rounding; scores are whole numbers.
        room = max(0.5, 1e-9 * np.abs(values[:, 0]).sum())
        taken = np.searchsorted(np.cumsum(falls.ravel()[steps]), values[:, 0].sum() - floor + room)
        return np.bincount(steps[: taken + 1] // falls.shape[1], minlength=len(values))

    def best(self, query: int, w: np.ndarray, k: int, floor: float) -> tuple[list[tuple], int]:
        """((query, vector, score) of the ``k`` best that score ``floor`` or more, ties to the smaller id; vectors scored).

        A list is read from the end that its weight prefers; vectors that come up are scored. The k-th score so far is a
        floor. No vector that hasn't come up can score more than the sum, over the lists, of the weighted components read
        last. Lists are read on, the steepest first and none more than four times as deep as before, until that
        sum is below the floor; there the search stops, and also when every vector has come up.
        """
        n, values = len(self.ids), self.values(w)
        seen, lists = self.ids == query, np.arange(len(w))
        others = n - int(seen.sum())
        none = np.iinfo(np.int64).min if self.vectors.dtype.kind == "i" else -np.inf
        scores, done = np.full(n, none, self.vectors.dtype), 0
        stops = np.zeros(len(w), np.int64)
        if floor == -np.inf:
            stops[:] = self.first
        while True:
            for i in lists[(w != 0) & (stops > 0)].tolist():
                depth = self.depths[stops[i]]
                seen[self.order[i, n - depth :] if w[i] > 0 else self.order[i, :depth]] = True
            new = np.nonzero(seen & (scores == none) & (self.ids != query))[0]
            if len(new):
                scores[new] = (self.vectors if len(new) == n else self.vectors[new]) @ w
                done += len(new)
                if done >= k:
                    floor = max(floor, np.partition(scores, n - k)[n - k])
            if done == others or values[lists, stops].sum() < floor:
                break
            wanted = self.stops_below(w, values, floor) if floor > -np.inf else np.full(len(w), len(self.depths) - 1)
            deeper = np.maximum(stops, np.minimum(wanted, np.maximum(stops, self.first) + 4))
            if (deeper == stops).all():
                if (stops == len(self.depths) - 1).all() or (w == 0).all():
                    seen[:] = True  # lists that are level to their end tell nothing
                    continue
                deeper = np.minimum(stops + 1, len(self.depths) - 1)
            stops = deeper
        good = np.nonzero((scores >= floor) & (scores != none))[0]
        chosen = good[np.lexsort((self.ids[good], -scores[good]))[:k]]
        return [(query, int(self.ids[i]), int(scores[i])) for i in chosen], done


def threshold_topk(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray | None = None
) -> tuple[list[tuple], np.ndarray]:
    """((query, vector, score) of each query's ``k`` best vectors of one block that reach its floor; vectors scored by query)."""
    lists, found, work = SortedLists(ids, vectors), [], np.zeros(len(queries), np.int64)
    for n, (query, w) in enumerate(zip(query_ids.tolist(), queries, strict=True)):
        rows, work[n] = lists.best(query, w, k, -np.inf if floors is None else floors[n])
        found += rows
    return found, work


def number_kind(width: int, most: int) -> str:
    """The smallest kind of numbers that holds all products and sums of integers exactly; floating ones multiply fast."""
    size = width * (most + 1) ** 2
    if size >= 1 << 62:
        raise ValueError(f"components of up to {most} are too large for exact products")
    return "f4" if size < 1 << 23 else "f8" if size < 1 << 52 else "i8"


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    rows = column.combine_chunks()
    return rows.flatten().to_numpy().reshape(len(rows), -1).astype(kind)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("scored", pa.int64())])


def _searcher(k: int, kind: str):
    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return _FOUND.empty_table()
        floors = asked.column("floor").to_numpy(zero_copy_only=False)
        queries = asked.column("query_id").to_numpy()
        found, work = threshold_topk(
            rows.column("vec_id").to_numpy(), _matrix(rows.column("parts"), kind), queries, _matrix(asked.column("parts"), kind), k, floors
        )
        # A row without a vector tells the work.
        found = [(*f, None) for f in found] + [(q, None, None, n) for q, n in zip(queries.tolist(), work.tolist(), strict=True)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _FOUND.types, strict=True)], schema=_FOUND)

    return search


def _bounder(kind: str, highest: bool):
    """Blocks in which a query could reach its floor by their extremes, or the one where it could score the highest."""
    schema = pa.schema([("query_id", pa.int64()), ("block", pa.int64()), ("bound", pa.float64()), ("floor", pa.float64())])

    def bound(ends: pa.Table, asked: pa.Table) -> pa.Table:
        if not ends.num_rows or not asked.num_rows:
            return schema.empty_table()
        high, low = _matrix(ends.column("high"), kind), _matrix(ends.column("low"), kind)
        blocks, w, floors = ends.column("block").to_numpy(), _matrix(asked.column("parts"), kind), asked.column("floor").to_numpy()
        out = []
        for start in range(0, len(w), 256):
            some = w[start : start + 256]
            bounds = np.maximum(some, 0) @ high.T + np.minimum(some, 0) @ low.T
            if highest:
                at, of = np.arange(len(some)), bounds.argmax(axis=1)
            else:
                at, of = np.nonzero(bounds >= floors[start : start + 256, None])
            ids = asked.column("query_id").to_numpy()[start : start + 256]
            out.append((ids[at], blocks[of], bounds[at, of].astype(float), floors[start : start + 256][at]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return bound


def _bounds(ends: DataFrame, asked: DataFrame, spans: int, sides: int, kind: str, highest: bool) -> DataFrame:
    """Pairs of query and block worth a look, from a grid of spans of blocks and sides of queries."""
    across = F.explode(F.sequence(F.lit(0), F.lit(sides - 1))).alias("side")
    left = ends.select("width", "span", across, "block", "high", "low")
    along = F.explode(F.sequence(F.lit(0), F.lit(spans - 1))).alias("span")
    right = asked.select(F.col("width").alias("w"), along, F.col("side").alias("s"), "query_id", "parts", "floor")
    pairs = left.groupBy("width", "span", "side").cogroup(right.groupBy("w", "span", "s"))
    return pairs.applyInArrow(_bounder(kind, highest), "query_id long, block long, bound double, floor double")


def _look(rows: DataFrame, asked: DataFrame, visits: DataFrame, k: int, kind: str) -> DataFrame:
    """What the visits find: a block's rows go once to every side that has a query for it."""
    asked = asked.drop("floor").join(visits, "query_id")
    met = asked.select(F.col("block").alias("b"), F.col("side").alias("of")).distinct()
    rows = rows.join(met, F.col("block") == F.col("b")).select("block", "of", "vec_id", "parts")
    pairs = rows.groupBy("block", "of").cogroup(asked.groupBy("block", "side"))
    return pairs.applyInArrow(_searcher(k, kind), "query_id long, vec_id long, score long, scored long")


def topk_with_work(vectors: DataFrame, is_query: Column, k: int = 20, embedding: str = "embedding", scale: int = 64) -> TopK:
    """The rows of :func:`exact_topk`, and how many vectors and blocks each query's search looked at."""
    parts = integer_parts(embedding, scale)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), parts.alias("parts"), is_query.alias("asks"))
    rows = rows.where("vec_id is not null and size(parts) > 0").withColumn("width", F.size("parts"))
    norm = F.aggregate("parts", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("norm", norm), "parts")
    asked = rows.where("asks").groupBy("vec_id").agg(F.min(F.struct("parts", "width")).alias("v"))
    sizes = rows.agg(F.count("*"), F.max("width"), F.max(F.greatest(F.abs(F.array_max("parts")), F.abs(F.array_min("parts")))))
    n, width, most = sizes.first()
    q = asked.count()
    kind = number_kind(width, most) if n else "f8"
    sides = max(1, -(-q // QUERIES))
    side = F.pmod(F.xxhash64("vec_id"), F.lit(sides)).cast("int").alias("side")
    asked = stored(asked.select(F.col("vec_id").alias("query_id"), "v.parts", "v.width", side, F.lit(float("-inf")).alias("floor")), "queries")
    # Blocks of one width and of like norm: the extremes of short vectors are small.
    placed = with_place(rows.select("width", "norm", "row", "vec_id", "parts"), ["width"], [F.desc("norm"), "row"], "place")
    block = F.col("width").cast("long") * (1 << 40) + F.floor(F.col("place") / BLOCK)
    rows = stored(placed.select("width", block.alias("block"), "vec_id", "parts"), "blocks")
    ends = rows.select("width", "block", F.posexplode("parts").alias("at", "x")).groupBy("width", "block", "at")
    ends = ends.agg(F.max("x").alias("high"), F.min("x").alias("low")).groupBy("width", "block")
    ends = ends.agg(*[F.sort_array(F.collect_list(F.struct("at", c))).getField(c).alias(c) for c in ("high", "low")])
    spans = max(1, -(-n // (BLOCK * BLOCK)))
    ends = stored(ends.withColumn("span", F.pmod(F.xxhash64("block"), F.lit(spans)).cast("int")), "extremes")
    # Each query first looks into the block that could hold its best; the k-th score found there is its floor in the others.
    first = _bounds(ends, asked, spans, sides, kind, highest=True)
    first = first.groupBy("query_id").agg(F.max_by("block", "bound").alias("block")).withColumn("floor", F.lit(float("-inf")))
    first = stored(first, "visits")
    early = stored(_look(rows, asked, first, k, kind), "first")
    scored = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = early.where("vec_id is not null").withColumn("rank", F.row_number().over(scored))
    # Doubles are a little off for the largest scores: the floor is on the safe side.
    score = F.col("score").cast("double")
    floor = (score - F.abs(score) * 1e-14 if kind == "i8" else score).alias("floor")
    kth = ranked.where(F.col("rank") == k).select("query_id", floor)
    known = F.coalesce("floor", F.lit(float("-inf"))).alias("floor")
    asked = asked.drop("floor")
    asked = stored(asked.join(kth, "query_id", "left").select(*asked.columns, known), "floors")
    others = _bounds(ends, asked, spans, sides, kind, highest=False).select("query_id", "block", "floor")
    others = stored(others.join(first.select("query_id", "block"), ["query_id", "block"], "left_anti"), "visits")
    late = stored(_look(rows, asked, others, k, kind), "others")
    found = early.unionAll(late)
    best = found.where("vec_id is not null").withColumn("rank", F.row_number().over(scored)).where(F.col("rank") <= k)
    work = found.where("vec_id is null").groupBy("query_id").agg(F.sum("scored").alias("scored"), F.count("*").alias("blocks"))
    return TopK(best.select("query_id", "rank", "vec_id", "score"), work)


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 20, embedding: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's ``k`` rows of highest integer inner product, itself left out.

    ``vectors`` has vec_id and an array of numbers; other columns are not read. Components are floor(scale * x). Ties go to
    the smaller vec_id. Vectors that are null, empty or hold null or non-finite components take no part, nor do rows with
    a null vec_id; vectors are only compared with others of their length. Rows that repeat a vec_id are all candidates; as
    queries they are one, by their smallest vector. Fewer than ``k`` candidates give all. ValueError for components so
    large that products don't fit into 62 bits.

    Rows are dealt to blocks by norm. No row of a block can score more than the block's extremes allow. A query first looks
    into the block with the highest such bound; the k-th score found there is its floor, and it visits only blocks
    whose bound reaches the floor. Within a block it reads sorted lists (``SortedLists.best``). A block's rows are
    sent once per 8,192 of the queries that visit it.
    """
    return topk_with_work(vectors, is_query, k, embedding, scale).rows
