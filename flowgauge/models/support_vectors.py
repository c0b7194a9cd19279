"""Epsilon-insensitive regression on given features, with its duality gap."""

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Step lengths that are tried at once where a whole Newton step goes too far.
LENGTHS = 0.5 ** np.arange(1, 24)
#: Newton steps for one width of the smoothed corner, and widths, each a fifth of the one before.
NEWTON, WIDTHS, NARROWER = 40, 16, 5.0
#: Steps end where they would gain less than this share: slopes, which the gap is made of, settle after the objective.
SETTLED = 1e-12
#: Rows whose features are made at once: they stay in a core's cache.
ROWS_AT_ONCE = 2_048
#: Rows of sums that reach the driver from one pass, whatever the number of tasks.
GATHERED = 16

Features = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]
#: What a fit asks of a pass: sums to make of features and labels, and how many numbers they are.
Asked = tuple[Callable[[np.ndarray, np.ndarray], np.ndarray], int]


@dataclass(frozen=True)
class SupportVectorFit:
    """Weights and intercept; ``gap`` is at least what the objective is above the least possible."""

    weights: np.ndarray
    intercept: float
    objective: float
    gap: float
    passes: int


def _total(rows: DataFrame, work: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of what ``work`` makes of a batch; tasks' sums are added up on the executors first."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                total += work(batch.slice(start, ROWS_AT_ONCE))
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId() % GATHERED], "sums": [total.tobytes()]})

    def gather(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(s, np.float64) for s in table.column("sums").to_pylist()], axis=0)
        return pa.table({"sums": [total.tobytes()]})

    parts = rows.mapInArrow(partial, "part long, sums binary").groupBy("part").applyInArrow(gather, "sums binary")
    return np.sum([np.frombuffer(r["sums"], np.float64) for r in parts.collect()], axis=0) if size else np.zeros(0)


def fit_support_vectors(
    rows: DataFrame, label: str, features: Features, size: int, c: float = 1.0, epsilon: float = 0.1, tolerance: float = 5e-4
) -> SupportVectorFit:
    """The fit of one label (``support_vector_steps``); ``features`` gives features and labels of a batch of ``rows``, without nulls."""

    def both(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
        z, y = features(batch)
        return z, [y]

    return fit_together(rows, both, [support_vector_steps(size, c, epsilon, tolerance)])[0]


def fit_together(
    rows: DataFrame, features: Callable[[pa.RecordBatch], tuple[np.ndarray, list[np.ndarray]]], fits: list[Generator]
) -> list[SupportVectorFit]:
    """Fits of several labels on the same features, which every pass makes once for all fits that still go on.

    ``features`` gives the features and each fit's labels of a batch; rows whose label is NaN take no part in its fit.
    """
    asked: dict[int, Asked] = {i: next(fit) for i, fit in enumerate(fits)}
    done: dict[int, SupportVectorFit] = {}
    while asked:
        now = dict(asked)

        def sums(batch: pa.RecordBatch) -> np.ndarray:
            z, labels = features(batch)
            parts = []
            for i, (work, _) in now.items():
                known = ~np.isnan(labels[i])
                parts.append(work(z, labels[i]) if known.all() else work(z[known], labels[i][known]))
            return np.concatenate(parts)

        found, at = _total(rows, sums, sum(size for _, size in now.values())), 0
        for i, (_, size) in now.items():
            try:
                asked[i] = fits[i].send(found[at : at + size])
            except StopIteration as end:
                done[i] = end.value
                del asked[i]
            at += size
    return [done[i] for i in range(len(fits))]


def support_vector_steps(
    size: int, c: float = 1.0, epsilon: float = 0.1, tolerance: float = 5e-4
) -> Generator[Asked, np.ndarray, SupportVectorFit]:
    """Least of |w|^2 / 2 + c * sum of max(0, |y - w z - b| - epsilon), with a free intercept b.

    A generator that asks for sums over all rows, each in one pass, and returns the fit. The corners of the loss
    are rounded off by a parabola of some width, and the smooth problem is solved by Newton steps; each is one pass that
    adds up gradient and curvature, (size + 1)^2 numbers a task. The width shrinks until the duality gap, which the same
    pass gives, is within ``tolerance`` of the objective. No kernel matrix, no row reaches the driver.
    """

    def bounded(z: np.ndarray) -> np.ndarray:
        return np.hstack([z, np.ones((len(z), 1))])

    def moments(z: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.array([len(y), y.sum(), (y * y).sum()])

    n, total, squares = yield moments, 3
    if not n:
        raise ValueError("no rows to fit")
    w = np.zeros(size + 1)
    w[-1] = total / n
    spread = float(np.sqrt(max(0.0, squares / n - w[-1] ** 2)))
    d = size + 1

    def at(w: np.ndarray, width: float) -> Generator[Asked, np.ndarray, tuple]:
        def sums(z: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = bounded(z)
            wrong = y - z @ w
            over = np.abs(wrong) - epsilon
            inside, beyond = (over > 0) & (over <= width), over > width
            slope = np.sign(wrong) * np.where(inside, over / width, beyond)
            smooth = np.where(inside, over * over / (2 * width), np.where(beyond, over - width / 2, 0)).sum()
            exact, near = np.maximum(over, 0).sum(), z[inside]
            ends = [smooth, exact, slope @ y, np.abs(slope).sum()]
            return np.concatenate([ends, z.T @ slope, (near.T @ near).ravel()])

        found = yield sums, 4 + d + d * d
        smooth, exact, with_label, size_of = found[:4]
        pull, curve = c * found[4 : 4 + d], c / width * found[4 + d :].reshape(d, d)
        penalty = w[:-1] @ w[:-1] / 2
        # The slopes of the rounded loss are a point of the dual problem.
        dual = c * with_label - epsilon * c * size_of - pull[:-1] @ pull[:-1] / 2
        gradient = np.append(w[:-1], 0.0) - pull
        return penalty + c * smooth, penalty + c * exact, dual, gradient, curve + np.diag([1.0] * size + [0.0])

    def lengths(w: np.ndarray, step: np.ndarray, width: float) -> Generator[Asked, np.ndarray, np.ndarray]:
        def sums(z: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = bounded(z)
            over = np.abs((y - z @ w)[:, None] - (z @ step)[:, None] * LENGTHS) - epsilon
            return np.where(over > width, over - width / 2, np.maximum(over, 0) ** 2 / (2 * width)).sum(axis=0)

        moved = w[:-1, None] + step[:-1, None] * LENGTHS
        return (moved * moved).sum(axis=0) / 2 + c * (yield sums, len(LENGTHS))

    width, passes, best = max(2 * spread, epsilon, 1e-12), 1, None
    for _ in range(WIDTHS):
        now, passes = (yield from at(w, width)), passes + 1
        for _ in range(NEWTON):
            smooth, _, _, gradient, curve = now
            # Without a row in the rounded corner nothing holds the intercept; a little does, and the step is shortened.
            hold = np.zeros(d)
            hold[-1] = 1e-9 * c * n / width
            step = -np.linalg.solve(curve + np.diag(hold), gradient)
            gain = -gradient @ step
            if gain <= SETTLED * max(abs(smooth), 1e-300):
                break
            ahead, passes = (yield from at(w + step, width)), passes + 1
            if ahead[0] > smooth - 1e-4 * gain:
                values, passes = (yield from lengths(w, step, width)), passes + 1
                step = step * LENGTHS[int(values.argmin())]
                if values.min() >= smooth:
                    break
                ahead, passes = (yield from at(w + step, width)), passes + 1
            w, now = w + step, ahead
        _, objective, dual, gradient, _ = now
        # A dual point needs slopes that add up to nothing; what they are off by counts at the labels' spread.
        gap = objective - dual + abs(gradient[-1]) * spread
        if best is None or gap < best.gap:
            best = SupportVectorFit(w[:-1].copy(), float(w[-1]), float(objective), float(gap), passes)
        if gap <= tolerance * max(objective, 1e-300):
            break
        width /= NARROWER
    return SupportVectorFit(best.weights, best.intercept, best.objective, best.gap, passes)
