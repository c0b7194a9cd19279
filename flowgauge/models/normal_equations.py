"""Least squares from counts, means and covariances, which add up over parts of a table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the largest axis of the features' correlations below which an axis counts as none.
DEPENDENT = 1e-12
SCORES = "target string, fold int, n bigint, mse double, rmse double, r2 double"


@dataclass(frozen=True)
class Line:
    """Intercept and weight by feature, in the features' own units."""

    features: tuple[str, ...]
    weights: np.ndarray
    intercept: float

    def coefficients(self) -> dict[str, float]:
        """As ``linear_predictor`` takes them."""
        return {"": self.intercept, **dict(zip(self.features, self.weights.tolist(), strict=True))}


@dataclass(frozen=True)
class Moments:
    """Row count, means and sums of products of deviations of some columns. ``a + b`` is that of the rows of both.

    Parts are merged by their means' differences, so that nothing is lost where means are large against deviations.
    """

    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, apart = self.n + other.n, other.mean - self.mean
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(self.columns, n, self.mean + apart * (other.n / n), products)

    def _places(self, features: tuple[str, ...], target: str) -> tuple[list[int], int]:
        return [self.columns.index(f) for f in features], self.columns.index(target)

    def line(self, features: tuple[str, ...], target: str, ridge: float = 0.0) -> Line:
        """The least squares line on scaled features, of least weights where many are as good; ``ridge`` shrinks weights."""
        x, y = self._places(features, target)
        deviation = np.sqrt(np.diag(self.products)[x] / self.n)
        deviation[deviation == 0] = 1.0
        between = self.products[np.ix_(x, x)] / self.n / np.outer(deviation, deviation)
        sizes, axes = np.linalg.eigh(between)
        # Axes along which features depend on each other have nothing but rounding for a size.
        kept = sizes > DEPENDENT * max(sizes.max(initial=0.0), 1.0)
        along = axes.T @ (self.products[x, y] / self.n / deviation)
        weights = axes[:, kept] @ (along[kept] / (sizes[kept] + ridge)) / deviation
        return Line(tuple(features), weights, float(self.mean[y] - weights @ self.mean[x]))

    def score(self, line: Line, target: str) -> tuple[int, float, float, float]:
        """n, MSE, RMSE and R2 of a line on these rows; none of them is needed again for it."""
        x, y = self._places(line.features, target)
        w, c = line.weights, self.products / self.n
        shift = self.mean[y] - line.intercept - w @ self.mean[x]
        mse = max(0.0, float(c[y, y] - 2 * w @ c[x, y] + w @ c[np.ix_(x, x)] @ w + shift * shift))
        r2 = 1 - mse / c[y, y] if c[y, y] > 0 else float(mse == 0)
        return self.n, mse, mse**0.5, float(r2)


def moments(df: DataFrame, columns: list[str], by: str) -> dict[object, Moments]:
    """Moments of the rows of every value of ``by``, in one aggregation; rows with a null in any column are left out.

    One row per value reaches the driver: ``by`` is a calendar date or a fold. The aggregation has some n * n / 2 sums for
    n columns, so it is meant for dozens of columns.
    """
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    values = df.dropna("any", subset=[*columns, by]).select(by, *[F.col(c).cast("double").alias(c) for c in columns])
    sums = [F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]
    sums += [F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs]
    found = {}
    for row in values.groupBy(by).agg(F.count("*").alias("n"), *sums).collect():
        products = np.zeros((len(columns), len(columns)))
        for i, j in pairs:
            products[i, j] = products[j, i] = row[f"c{i}_{j}"] * row["n"]
        mean = np.array([row[f"m{i}"] for i in range(len(columns))])
        found[row[by]] = Moments(tuple(columns), row["n"], mean, products)
    return found


def linear_folds(
    table: DataFrame, features: list[str], targets: list[str], folds: int = 5, order: str = "date", ridge: float = 0.0
) -> tuple[dict[str, Line], list[tuple]]:
    """The line of all rows per target, and (target, fold, n, mse, rmse, r2) of the lines of all rows but a fold's on it.

    Folds are contiguous blocks of the distinct dates, larger ones first. The table is read once: moments are taken by date,
    a fold's are the sum of its dates', and the training side's the sum of the other folds'. Lines are solved and scored
    from these numbers. Scaling is learned on the training side.
    """
    dates = moments(table, [*features, *targets], order)
    if not dates:
        return {}, []
    names, none = tuple([*features, *targets]), np.zeros(0)
    empty = Moments(names, 0, none, none)
    blocks = [block for block in np.array_split(sorted(dates), folds) if len(block)]
    parts = [sum((dates[d] for d in block.tolist()), empty) for block in blocks]
    scores = []
    for fold, part in enumerate(parts):
        rest = sum(parts[:fold] + parts[fold + 1 :], empty)
        for target in targets if rest.n else []:
            scores.append((target, fold, *part.score(rest.line(tuple(features), target, ridge), target)))
    whole = sum(parts, empty)
    return {target: whole.line(tuple(features), target, ridge) for target in targets}, scores


def linear_cv(
    table: DataFrame, features: list[str], targets: list[str], folds: int = 5, order: str = "date", ridge: float = 0.0
) -> DataFrame:
    """``target``, ``fold``, ``n``, ``mse``, ``rmse``, ``r2`` of least squares lines, see :func:`linear_folds`."""
    return table.sparkSession.createDataFrame(linear_folds(table, features, targets, folds, order, ridge)[1], SCORES)
