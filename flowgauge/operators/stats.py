"""Descriptions and scores."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.operators.ranks import counted_values, double_of_key, keys_at_ranks
from flowgauge.operators.rows import last_rows

QUARTERS = {"p25": 1, "p50": 2, "p75": 3}


def describe_exact(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, a row per column.

    For any numeric columns: whole ones are exact to the last digit, others are read as doubles. Nulls and NaN do not count; a
    column without values has a count of 0 and nulls. Rows are reduced to (value, frequency) once; the quartiles, which lie
    between two neighbouring ranks each, are then found by counting leading digits of the values, of all columns at once
    (``keys_at_ranks``). No number of values is too many. Runs at once, as the passes depend on each other; the driver sees
    a few numbers per column.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    for name, kind in kinds.items():
        if not isinstance(kind, T.NumericType):
            raise TypeError(f"{name} is not a numeric column")
    whole = [c for c in columns if isinstance(kinds[c], T.IntegralType)]
    counted = counted_values(df, whole, [c for c in columns if c not in whole])
    value, times = F.col("value"), F.col("times")
    sums = counted.groupBy("column").agg(
        F.sum("times").alias("n"), F.sum(value * times).alias("total"), F.min("key").alias("least"), F.max("key").alias("greatest")
    )
    found = {r["column"]: r for r in sums.collect()}
    ranks = {c: {(r["n"] - 1) * k // 4 + up for k in QUARTERS.values() for up in (0, 1)} for c, r in found.items()}
    ranks = {c: {min(rank, found[c]["n"] - 1) for rank in wanted} for c, wanted in ranks.items()}
    keys = keys_at_ranks(counted, {c: (r["least"], r["greatest"]) for c, r in found.items()}, ranks)
    squares = {}
    if found:
        means = F.create_map(*[F.lit(x) for c, r in found.items() for x in (c, r["total"] / r["n"])])
        off = value - means[F.col("column")]
        squares = dict(counted.groupBy("column").agg(F.sum(off * off * times)).collect())

    def number(column: str, key: int) -> float:
        return key if column in whole else double_of_key(key)

    rows = []
    for column in columns:
        if column not in found:
            rows.append((column, 0, *[None] * 7))
            continue
        n, quartiles = found[column]["n"], []
        for k in QUARTERS.values():
            rank, part = divmod((n - 1) * k, 4)
            low, high = (float(number(column, keys[column, min(r, n - 1)])) for r in (rank, rank + 1))
            quartiles.append(low if low == high else low * (1 - part / 4) + high * (part / 4) if part else low)
        ends = [number(column, found[column][e]) for e in ("least", "greatest")]
        if len(whole) < len(columns):
            ends = [float(e) for e in ends]
        std = math.sqrt(squares[column] / (n - 1)) if n > 1 else None
        rows.append((column, n, found[column]["total"] / n, std, ends[0], *quartiles, ends[1]))
    end = "bigint" if len(whole) == len(columns) else "double"
    schema = f"column string, count bigint, mean double, std double, min {end}, {', '.join(f'{q} double' for q in QUARTERS)}, max {end}"
    return df.sparkSession.createDataFrame(rows, schema)


def regression_metrics(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Row count, MSE, RMSE and R2 per group, in one aggregation.

    With a constant label R2 is 1 for a perfect fit and 0 otherwise.
    """
    by = by or []
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    scored = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.var_pop(y).alias("_var"),
    )
    r2 = (
        F.when(F.col("_var") > 0, 1 - F.col("mse") / F.col("_var"))
        .when(F.col("mse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return scored.select(*by, "n", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


def fold_summary(scores: DataFrame, by: list[str]) -> DataFrame:
    """Mean and population deviation of fold scores."""
    return scores.groupBy(*by).agg(
        F.avg("r2").alias("r2_mean"),
        F.stddev_pop("r2").alias("r2_std"),
        F.avg("rmse").alias("rmse_mean"),
        F.stddev_pop("rmse").alias("rmse_std"),
    )


def best_model(
    leaderboard: DataFrame, metric: str, by: list[str], order: str, name: str = "model", highest: bool = False
) -> DataFrame:
    """Winner per group; NaN never wins and the lowest ``order`` wins a tie."""
    score = -F.col(metric) if highest else F.col(metric)
    usable = leaderboard.where(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double")))
    winner = F.min_by(F.struct(F.col(name), F.col(metric)), F.struct(score, F.col(order)))
    return usable.groupBy(*by).agg(winner.alias("_best")).select(*by, f"_best.{name}", f"_best.{metric}")


def tail_mean(df: DataFrame, order: str, columns: list[str], n: int = 7, keys: list[str] | None = None) -> DataFrame:
    """Mean of the last ``n`` rows, per key if keys are given."""
    tail = last_rows(df, order, n, keys)
    return tail.groupBy(*(keys or [])).agg(*[F.avg(c).alias(c) for c in columns])
