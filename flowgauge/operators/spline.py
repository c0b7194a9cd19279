"""Cubic spline through each series, however long: blocks of knots are solved apart and joined at their first knots."""

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.operators.order import with_row_number
from flowgauge.session import scratch_path

#: Knots that one task solves at once; a series' last block may have up to twice as many.
BLOCK = 1 << 16
#: Fewest knots of a block, and of a series that gets a curve.
FEWEST = 4
_OWN, _BEFORE, _AFTER = 0, -1, 1


class _Block(NamedTuple):
    """Knots of a block, and the first of the next one if there is one. Second derivatives of the knots between the ends
    are ``free + left * first + right * next``, by those of the block's first knot and of the next block's."""

    x: np.ndarray
    y: np.ndarray
    free: np.ndarray
    left: np.ndarray
    right: np.ndarray


def _solve(x: np.ndarray, y: np.ndarray, first: bool, last: bool) -> _Block:
    """Eliminate the knots within a block of the not-a-knot spline.

    ``first`` and ``last`` say whether the series begins and ends here: its outer knots are then expressed by their
    neighbours. What is left is a tridiagonal system: linear in time and memory.
    """
    h = np.diff(x)
    lower, upper = h[:-1].copy(), h[1:].copy()
    diagonal = 2.0 * (h[:-1] + h[1:])
    if first:
        diagonal[0] += h[0] * (1.0 + h[0] / h[1])
        upper[0] -= h[0] * h[0] / h[1]
    if last:
        diagonal[-1] += h[-1] * (1.0 + h[-1] / h[-2])
        lower[-1] -= h[-1] * h[-1] / h[-2]
    lower, upper, diagonal = lower.tolist(), upper.tolist(), diagonal.tolist()
    free = (6.0 * np.diff(np.diff(y) / h)).tolist()
    n = len(free)
    left, right = [0.0] * n, [0.0] * n
    left[0] = 0.0 if first else -lower[0]
    right[-1] = 0.0 if last else -upper[-1]
    for i in range(1, n):
        factor = lower[i] / diagonal[i - 1]
        diagonal[i] -= factor * upper[i - 1]
        free[i] -= factor * free[i - 1]
        left[i] -= factor * left[i - 1]
    for side in (free, left, right):
        side[-1] /= diagonal[-1]
        for i in range(n - 2, -1, -1):
            side[i] = (side[i] - upper[i] * side[i + 1]) / diagonal[i]
    return _Block(x, y, np.array(free), np.array(left), np.array(right))


def _derivatives(block: _Block, first: float | None, after: float | None) -> np.ndarray:
    """Second derivatives at all knots of a block, given those of its first knot and of the next block's, if any."""
    m = np.empty(len(block.x))
    m[1:-1] = block.free + block.left * (first or 0.0) + block.right * (after or 0.0)
    h = np.diff(block.x)
    m[0] = m[1] + (m[1] - m[2]) * h[0] / h[1] if first is None else first
    m[-1] = m[-2] + (m[-2] - m[-3]) * h[-1] / h[-2] if after is None else after
    return m


def _curve(block: _Block, m: np.ndarray, at: np.ndarray) -> np.ndarray:
    x, y = block.x, block.y
    k = np.clip(np.searchsorted(x, at, side="right") - 1, 0, len(x) - 2)
    h = x[k + 1] - x[k]
    left, right = (x[k + 1] - at) / h, (at - x[k]) / h
    bend = ((left**3 - left) * m[k] + (right**3 - right) * m[k + 1]) * h * h / 6.0
    return left * y[k] + right * y[k + 1] + bend


def spline_values(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The spline through ``(x, y)``, at least four knots, at the points ``at``."""
    block = _solve(x, y, True, True)
    return _curve(block, _derivatives(block, None, None), at)


def _block_of(group: pd.DataFrame) -> _Block:
    """A block from its own knots and its neighbours' nearest ones."""
    group = group.sort_values("x")
    inner = group[group["role"] != _BEFORE]
    first, last = not (group["role"] == _BEFORE).any(), not (group["role"] == _AFTER).any()
    return _solve(inner["x"].to_numpy("float64"), inner["y"].to_numpy("float64"), first, last)


def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """One row a block: what its first knot's equation needs of the block and of the knot before it."""
    block = _block_of(group)
    out = {"k": [group["k"].iloc[0]], "block": [group["block"].iloc[0]]}
    for name, side in (("free", block.free), ("left", block.left), ("right", block.right)):
        out[f"{name}_1"], out[f"{name}_n"] = [side[0]], [side[-1]]
    before = group[group["role"] == _BEFORE]
    if len(before):
        h = block.x[0] - before["x"].iloc[0]
        ahead = block.x[1] - block.x[0]
        bend = 6.0 * ((block.y[1] - block.y[0]) / ahead - (block.y[0] - before["y"].iloc[0]) / h)
        out |= {"back": [h], "ahead": [ahead], "bend": [bend]}
    else:
        out |= {"back": [0.0], "ahead": [0.0], "bend": [0.0]}
    return pd.DataFrame(out)


def _joints(group: pd.DataFrame) -> pd.DataFrame:
    """Second derivatives at the first knots of a series' blocks: a tridiagonal system with a row per block."""
    g = group.sort_values("block")
    n = len(g)
    c = {name: g[name].to_numpy("float64") for name in g.columns if name not in ("k", "block")}
    now, before = slice(1, None), slice(None, -1)
    lower = c["back"][now] * c["left_n"][before]
    diagonal = 2.0 * (c["back"][now] + c["ahead"][now]) + c["back"][now] * c["right_n"][before] + c["ahead"][now] * c["left_1"][now]
    upper = c["ahead"][now] * c["right_1"][now]
    value = c["bend"][now] - c["back"][now] * c["free_n"][before] - c["ahead"][now] * c["free_1"][now]
    for i in range(1, n - 1):
        factor = lower[i] / diagonal[i - 1]
        diagonal[i] -= factor * upper[i - 1]
        value[i] -= factor * value[i - 1]
    for i in range(n - 2, -1, -1):
        value[i] = (value[i] - (upper[i] * value[i + 1] if i < n - 2 else 0.0)) / diagonal[i]
    first = [None, *value.tolist()]
    return pd.DataFrame({"k": g["k"].to_numpy(), "block": g["block"].to_numpy(), "first": first, "after": [*first[1:], None]})


def _wall_micros(time: Column) -> Column:
    """Microseconds since 1970 as the clock shows them: no time zone is involved."""
    days = F.datediff(time, F.lit("1970-01-01").cast("date")).cast("long")
    seconds = (days * 24 + F.hour(time)) * 3600 + F.minute(time) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")


def spline_densify(df: DataFrame, key: str, x: str, y: str, n: int = 300, block: int | None = None) -> DataFrame:
    """``n`` points of a smooth curve through each key's series.

    A key with fewer than four points keeps its points as they are. ``x`` is a time or a number.

    A series is cut into blocks of knots. Each block is solved apart but for the second derivatives at its own first knot and the
    next block's; these joints, one a block, are solved together per series, and put back. So a task holds one
    block, or one joint per block of a series, and a short series is one block without joints.
    """
    spark = df.sparkSession
    block = max(block or BLOCK, FEWEST)
    kind = df.schema[x].dataType
    is_time = isinstance(kind, (T.TimestampNTZType, T.TimestampType))
    micros = _wall_micros(F.col(x)) if is_time else F.lit(None).cast("long")
    read = df.select(F.col(key).alias("k"), F.col(x).alias("given"), micros.alias("micros"), F.col(y).cast("double").alias("y"))
    numbered = with_row_number(read, ["k", "given"], "place")
    spans = numbered.groupBy("k").agg(
        F.min("place").alias("start"), F.count("*").alias("n"), F.min("given").alias("x_0"), F.max("given").alias("x_n"),
        F.min("micros").alias("origin"), F.max("micros").alias("end"),
    )
    series = numbered.join(spans.withColumnRenamed("k", "of"), F.col("k").eqNullSafe(F.col("of"))).drop("of")
    few = series.where(F.col("n") < FEWEST)
    blocks = F.greatest(F.floor(F.col("n") / block), F.lit(1))
    place = F.col("place") - F.col("start")
    own = F.least(F.floor(place / block), blocks - 1)
    hours = (F.col("micros") - F.col("origin")) / 3.6e9 if is_time else F.col("given").cast("double")
    lo = F.lit(0.0) if is_time else F.col("x_0").cast("double")
    hi = (F.col("end") - F.col("origin")) / 3.6e9 if is_time else F.col("x_n").cast("double")
    knots = series.where(F.col("n") >= FEWEST).select(
        "k", own.alias("own"), blocks.alias("blocks"), place.alias("place"), hours.alias("x"), "y", lo.alias("lo"), hi.alias("hi"), "origin"
    )
    opens = (F.col("own") > 0) & (F.col("place") == F.col("own") * block)
    closes = (F.col("own") < F.col("blocks") - 1) & (F.col("place") == (F.col("own") + 1) * block - 1)
    homes = F.array_compact(
        F.array(
            F.struct(F.col("own").alias("block"), F.lit(_OWN).alias("role")),
            F.when(opens, F.struct((F.col("own") - 1).alias("block"), F.lit(_AFTER).alias("role"))),
            F.when(closes, F.struct((F.col("own") + 1).alias("block"), F.lit(_BEFORE).alias("role"))),
        )
    )
    knots = knots.select("k", "x", "y", "lo", "hi", "origin", F.inline(homes))
    path = scratch_path(spark, "knots")
    knots.write.parquet(path)
    knots = spark.read.schema(knots.schema).parquet(path)
    k_field = T.StructField("k", df.schema[key].dataType)

    def fields(*names: str) -> T.StructType:
        return T.StructType([k_field, T.StructField("block", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in names]])

    sides = [f"{name}_{end}" for name in ("free", "left", "right") for end in ("1", "n")]
    ends = knots.groupBy("k", "block").applyInPandas(_ends, fields(*sides, "back", "ahead", "bend"))
    joints = ends.groupBy("k").applyInPandas(_joints, fields("first", "after"))
    out_x = kind if is_time else T.DoubleType()

    def draw(group: pd.DataFrame, joint: pd.DataFrame) -> pd.DataFrame:
        solved = _block_of(group)
        first, after = (None if pd.isna(joint[c].iloc[0]) else float(joint[c].iloc[0]) for c in ("first", "after"))
        lo, hi = float(group["lo"].iloc[0]), float(group["hi"].iloc[0])
        # The block's share of n even points from the series' first to its last knot.
        step = (hi - lo) / max(n - 1, 1)
        low, high = (int(np.floor((end - lo) / step)) if step else 0 for end in (solved.x[0], solved.x[-1]))
        numbers = np.arange(max(0, low - 1), min(n - 1, high + 1) + 1)
        at = lo + numbers * step
        at[numbers == n - 1] = hi if n > 1 else lo
        at = at[((at >= solved.x[0]) | (first is None)) & ((at < solved.x[-1]) | (after is None))]
        values = _curve(solved, _derivatives(solved, first, after), at)
        if is_time:
            at = (int(group["origin"].iloc[0]) + np.rint(at * 3.6e9).astype("int64")).astype("datetime64[us]")
        return pd.DataFrame({"k": group["k"].iloc[0], "x": at, "y": values})

    schema = T.StructType([k_field, T.StructField("x", out_x), T.StructField("y", T.DoubleType())])
    met = joints.withColumnRenamed("k", "of").withColumnRenamed("block", "b")
    curves = knots.groupBy("k", "block").cogroup(met.groupBy("of", "b")).applyInPandas(draw, schema)
    plain = few.select("k", F.col("given").cast(out_x).alias("x"), "y")
    return curves.unionByName(plain).select(F.col("k").alias(key), F.col("x").alias(x), F.col("y").alias(y))
