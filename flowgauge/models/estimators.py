"""The three kinds of regression that compete, as Spark ML estimators.

Every fitted model is a pipeline of Spark's own stages, so it can be saved and loaded.
"""

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    LinearRegression,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.models.support_vectors import SupportVectorFit, fit_together, support_vector_steps

SCALED = "_z"
RIDGE = 1e-8


def _scaling(df: DataFrame, columns: list[str]) -> tuple[int, dict[str, tuple[float, float]]]:
    """Row count, and mean and population deviation per column: one row of numbers."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    ).first()
    return row["n"], {c: (row[f"{c}_mean"] or 0.0, row[f"{c}_std"] or 0.0) for c in columns}


def _scaler(stats: dict[str, tuple[float, float]]) -> SQLTransformer:
    terms = [f"(`{c}` - ({mean!r}D)) / {(std or 1.0)!r}D AS `{c}{SCALED}`" for c, (mean, std) in stats.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


class PopulationScaler(Estimator):
    """Adds each column with zero mean and unit population deviation."""

    def __init__(self, columns: list[str]):
        super().__init__()
        self.columns = columns

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        return _scaler(_scaling(dataset, self.columns)[1])


def kernel_draws(features: int, gamma: float, size: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Directions and phases of ``size`` random waves for the Gaussian kernel exp(-gamma * distance^2)."""
    random = np.random.default_rng(seed)
    weights = random.normal(0.0, math.sqrt(2.0 * gamma), (size, features))
    return weights, random.uniform(0.0, 2.0 * math.pi, size)


class KernelRegression(Estimator):
    """Smooth regression with a Gaussian kernel, in the place of a support vector regressor.

    Random Fourier features (Rahimi and Recht, 2007) stand for the kernel and a ridge
    regression is fitted on them: the fit is one distributed pass, where a kernel solver would
    compare all pairs of rows. ``gamma="scale"`` is one over features times their variance.
    ``c`` weighs the errors against the penalty. ``loss="huber"`` counts large errors by their
    size and not their square, as a support vector regressor does; it is fitted in several
    passes. ``loss="epsilon"`` is the loss of a support vector regressor itself: errors up to
    ``epsilon`` cost nothing, others what they are above it (``support_vector_steps``); ``fit_``
    then holds the objective and its duality gap.
    """

    def __init__(
        self,
        features: list[str],
        label: str,
        size: int = 64,
        gamma: float | str = "scale",
        c: float = 1.0,
        loss: str = "squared",
        seed: int = 42,
        epsilon: float = 0.1,
    ):
        super().__init__()
        if loss not in ("squared", "huber", "epsilon"):
            raise ValueError("loss must be 'squared', 'huber' or 'epsilon'")
        self.loss, self.epsilon = loss, epsilon
        self.fit_: SupportVectorFit | None = None
        self.features, self.label = features, label
        self.size, self.gamma, self.c, self.seed = size, gamma, c, seed

    def _kernel(self, dataset: DataFrame) -> tuple[int, dict[str, tuple[float, float]], np.ndarray, np.ndarray]:
        """Row count, scaling, and the directions and phases of the waves."""
        n, stats = _scaling(dataset, self.features)
        varying = sum(1 for _, std in stats.values() if std > 0)
        # Scaled columns have variance 1 or 0, so features times variance is the varying ones.
        gamma = 1.0 / max(varying, 1) if self.gamma == "scale" else float(self.gamma)
        return n, stats, *kernel_draws(len(self.features), gamma, self.size, self.seed)

    def _wave_stages(self, stats: dict[str, tuple[float, float]], weights: np.ndarray, phases: np.ndarray) -> list:
        # The weights are one literal array, each wave's phase at its end: the generated code
        # stays small, and the same, whatever the number of waves.
        literal = ", ".join(
            f"array({', '.join(f'{float(v)!r}D' for v in [*row, phase])})" for row, phase in zip(weights, phases)
        )
        inputs = ", ".join(f"`{f}{SCALED}`" for f in self.features)
        wave = (
            f"{math.sqrt(2.0 / self.size)!r}D * cos(aggregate(zip_with(w, array({inputs}, 1.0D), (a, b) -> a * b), "
            "0.0D, (total, v) -> total + v))"
        )
        return [
            _scaler(stats),
            SQLTransformer(statement=f"SELECT *, transform(array({literal}), w -> {wave}) AS waves FROM __THIS__"),
        ]

    def waves(self, dataset: DataFrame) -> PipelineModel:
        """Adds the scaled features and ``waves``, whose products stand for the kernel; nothing is fitted but the scaling."""
        _, stats, weights, phases = self._kernel(dataset)
        return Pipeline(stages=self._wave_stages(stats, weights, phases)).fit(dataset)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        if self.loss == "epsilon":
            return fit_labels(dataset, [self])[0]
        n, stats, weights, phases = self._kernel(dataset)
        waves = self._wave_stages(stats, weights, phases)
        names = [f"wave_{i}" for i in range(self.size)]
        stages = [
            *waves,
            SQLTransformer(
                statement=f"SELECT *, {', '.join(f'waves[{i}] AS `{n}`' for i, n in enumerate(names))} FROM __THIS__"
            ),
            VectorAssembler(inputCols=names, outputCol="features"),
            LinearRegression(
                labelCol=self.label,
                regParam=1.0 / (self.c * max(n, 1)),
                standardization=False,
                loss="squaredError" if self.loss == "squared" else "huber",
                solver="normal" if self.loss == "squared" else "l-bfgs",
            ),
        ]
        return Pipeline(stages=stages).fit(dataset)

    def _support_line(self, fit: SupportVectorFit) -> SQLTransformer:
        """The last stage: prediction from the waves."""
        self.fit_ = fit
        literal = ", ".join(f"{float(v)!r}D" for v in fit.weights)
        line = f"aggregate(zip_with(waves, array({literal}), (a, b) -> a * b), {fit.intercept!r}D, (total, v) -> total + v)"
        return SQLTransformer(statement=f"SELECT *, {line} AS prediction FROM __THIS__")


def fit_labels(dataset: DataFrame, estimators: list[KernelRegression]) -> list[PipelineModel]:
    """Models of estimators with ``loss="epsilon"`` that differ in their labels, or in ``c`` and ``epsilon``, alone.

    The same as one fit after the other, but the waves are made once in every pass, for all labels that still need it.
    """
    first = estimators[0]
    if any((e.loss, e.features, e.size, e.gamma, e.seed) != ("epsilon", first.features, first.size, first.gamma, first.seed) for e in estimators):
        raise ValueError("estimators must share loss 'epsilon', features, size, gamma and seed")
    _, stats, weights, phases = first._kernel(dataset)
    columns, labels, scale = first.features, [e.label for e in estimators], math.sqrt(2.0 / first.size)
    mean = np.array([stats[f][0] for f in columns])
    deviation = np.array([stats[f][1] or 1.0 for f in columns])

    def features(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
        x = np.stack([batch.column(f).to_numpy() for f in columns], 1)
        y = [batch.column(f"_label_{i}").to_numpy(zero_copy_only=False) for i in range(len(labels))]
        return scale * np.cos((x - mean) / deviation @ weights.T + phases), y

    rows = dataset.dropna("any", subset=columns).dropna("all", subset=labels)
    doubles = [F.col(f).cast("double").alias(f) for f in columns]
    doubles += [F.col(label).cast("double").alias(f"_label_{i}") for i, label in enumerate(labels)]
    rows = rows.select(*doubles).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = fit_together(rows, features, [support_vector_steps(e.size, e.c, e.epsilon) for e in estimators])
    finally:
        rows.unpersist()
    waves = first._wave_stages(stats, weights, phases)
    return [Pipeline(stages=[*waves, e._support_line(fit)]).fit(dataset) for e, fit in zip(estimators, fits, strict=True)]


def scaled_pipeline(features: list[str], regressor: Estimator) -> Pipeline:
    assembler = VectorAssembler(inputCols=[f"{f}{SCALED}" for f in features], outputCol="features")
    return Pipeline(stages=[PopulationScaler(features), assembler, regressor])


def linear(features: list[str], label: str) -> Pipeline:
    """Least squares with intercept on scaled features, whatever their rank.

    Calendar features depend on each other: within a month the day is fixed by week and weekday.
    A ridge of ``RIDGE`` picks, of all least squares lines, the one of least weights, and keeps
    the normal equations solvable in one pass.
    """
    return scaled_pipeline(features, LinearRegression(labelCol=label, regParam=RIDGE, solver="normal"))


class ForestModel(RandomForestRegressionModel):
    """A forest whose trees are wrapped in Python only when asked for.

    Spark wraps every tree of a fitted forest at once, call by call, which for a small table
    takes longer than the fit and keeps fits from running side by side.
    """

    @property
    def trees(self) -> list:
        return [DecisionTreeRegressionModel(tree) for tree in list(self._call_java("trees"))]


class Forest(RandomForestRegressor):
    def _create_model(self, java_model: object) -> ForestModel:
        return ForestModel(java_model)


def random_forest(
    features: list[str], label: str, trees: int, depth: int, min_leaf: int = 1, bins: int = 32, seed: int = 42
) -> Pipeline:
    """Random forest that looks at every feature at every split.

    Deep forests remember the node of each row from level to level, in place of sending all
    trees grown so far to every task.
    """
    forest = Forest(
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        maxBins=bins,
        featureSubsetStrategy="all",
        cacheNodeIds=depth > 10,
        seed=seed,
    )
    return scaled_pipeline(features, forest)


Candidate = Callable[[list[str], str], Estimator]

# Kinds and settings are fixed values, in the order in which ties are decided. Spark's trees stop at depth 30, which is beyond what
# hour, minute, weekday and a station flag can be split into.
SLOT_CANDIDATES: dict[str, Candidate] = {
    "rbf_rff": lambda features, label: KernelRegression(features, label),
    "random_forest": lambda features, label: random_forest(features, label, trees=100, depth=30),
    "linear": linear,
}

# A leaf of at least three rows implies a split of at least six.
DAILY_CANDIDATES: dict[str, Candidate] = {
    "random_forest": lambda features, label: random_forest(
        features, label, trees=200, depth=10, min_leaf=3, bins=128
    ),
    "linear": linear,
    "rbf_rff": lambda features, label: KernelRegression(features, label),
}
