"""A generalised additive model with pairwise interactions, made of lookup tables.

Features are cut into bins. Boosting goes round the features in a fixed order; each step grows one shallow tree on one
feature's gradient histogram, and its leaves are added, shrunk, to that feature's table. When the single features are
done, the pairs whose residuals say most are boosted the same way on coarser bins of two features. A score is the sum of
one table entry per feature and pair: no tree is walked.
"""

from dataclasses import dataclass

import numpy as np

#: Shrinkage of a step; rounds without a better validation loss before boosting stops.
RATE, PATIENCE = 0.1, 25
RIDGE = 1.0
#: Rows that it takes to grow trees.
LEAST = 20


@dataclass
class AdditiveModel:
    """``edges[j]`` cuts feature j into bins; ``tables[j]`` holds the bins' log odds. Pairs use ``coarse`` edges."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], "right")]
        bins = {j: np.searchsorted(self.coarse[j], x[:, j], "right") for p in self.pairs for j in p[:2]}
        for i, j, table in self.pairs:
            out += table[bins[i], bins[j]]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.log_odds(np.asarray(x, np.float64)))


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -40, 40)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges of at most ``bins`` bins that hold about as many values each; ties stay together."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram in two; place 0 if none gains."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain = np.where((hl > 1e-6) & (hr > 1e-6), gain, 0)
    k = int(gain.argmax())
    return (float(gain[k]), k + 1) if gain[k] > 1e-9 else (0.0, 0)


def _tree_1d(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values by bin of a tree on one binned feature."""
    gain, k = _best_cut(g, h) if depth else (0.0, 0)
    if not k:
        return np.full(len(g), -g.sum() / (h.sum() + RIDGE))
    return np.concatenate([_tree_1d(g[:k], h[:k], depth - 1), _tree_1d(g[k:], h[k:], depth - 1)])


def _tree_2d(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values by cell of a tree on two binned features; each node cuts the axis that gains more."""
    rows, columns = _best_cut(g.sum(1), h.sum(1)), _best_cut(g.sum(0), h.sum(0))
    if not depth or not max(rows, columns)[1]:
        return np.full(g.shape, -g.sum() / (h.sum() + RIDGE))
    axis, k = (0, rows[1]) if rows[0] >= columns[0] else (1, columns[1])
    parts = zip(np.split(g, [k], axis), np.split(h, [k], axis), strict=True)
    return np.concatenate([_tree_2d(a, b, depth - 1) for a, b in parts], axis)


def _loss(y: np.ndarray, f: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, f) - y * f)) if len(y) else 0.0


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = 300, bins: int = 48, coarse_bins: int = 12, pairs: int = 10) -> AdditiveModel:
    """Fit to rows ``x`` with labels 0 and 1. One row in five is kept aside to stop the boosting.

    No rows, rows of one class only, or fewer than ``LEAST`` rows, which are too few to keep any aside, give a constant score:
    the smoothed share of label 1.
    """
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    n, d = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    bias = float(np.log(share / (1 - share)))
    edges = [_cuts(x[:, j], bins) if n else np.empty(0) for j in range(d)]
    coarse = [_cuts(x[:, j], coarse_bins) if n else np.empty(0) for j in range(d)]
    model = AdditiveModel(bias, edges, [np.zeros(len(e) + 1) for e in edges], coarse, [])
    if n < LEAST or not 0 < y.sum() < n:
        return model
    aside = np.zeros(n, bool)
    for label in (0, 1):  # both classes, in the order of the rows
        aside[np.nonzero(y == label)[0][::5]] = True
    fit, yf, yv = ~aside, y[~aside], y[aside]
    bx = [np.searchsorted(edges[j], x[:, j], "right") for j in range(d)]
    f = np.full(n, bias)
    parts = [(j, (bx[j],), model.tables[j]) for j in range(d)]
    _boost(parts, f, fit, aside, yf, yv, rounds, lambda g, h: _tree_1d(g, h, 2))
    # Pairs by the gain of a small tree on what the single features leave unexplained.
    cx = [np.searchsorted(coarse[j], x[:, j], "right") for j in range(d)]
    g, h = _gradients(yf, f[fit])
    gains = []
    for i in range(d):
        for j in range(i + 1, d):
            shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
            hist = [_histogram((cx[i][fit], cx[j][fit]), w, shape) for w in (g, h)]
            leaves = _tree_2d(*hist, 2)
            gains.append((float(-(hist[0] * leaves).sum()), -i, -j))
    model.pairs = [(-i, -j, np.zeros((len(coarse[-i]) + 1, len(coarse[-j]) + 1))) for _, i, j in sorted(gains, reverse=True)[:pairs]]
    parts = [(k, (cx[i], cx[j]), table) for k, (i, j, table) in enumerate(model.pairs)]
    _boost(parts, f, fit, aside, yf, yv, rounds // 2, lambda g, h: _tree_2d(g, h, 2))
    return model


def _gradients(y: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = _sigmoid(f)
    return p - y, np.maximum(p * (1 - p), 1e-6)


def _histogram(bins: tuple, weights: np.ndarray, shape: tuple) -> np.ndarray:
    flat = np.ravel_multi_index(bins, shape) if len(shape) > 1 else bins[0]
    return np.bincount(flat, weights, minlength=int(np.prod(shape))).reshape(shape)


def _boost(parts, f, fit, aside, yf, yv, rounds, tree) -> None:
    """Rounds over all tables, in place; the tables of the best validation loss stay."""
    best, kept, since = _loss(yv, f[aside]), [t.copy() for _, _, t in parts], 0
    at = [tuple(b[fit] for b in bins) for _, bins, _ in parts]
    for _ in range(rounds):
        for (_, bins, table), inside in zip(parts, at, strict=True):
            g, h = _gradients(yf, f[fit])
            step = RATE * tree(_histogram(inside, g, table.shape), _histogram(inside, h, table.shape))
            table += step
            f += step[bins]
        loss = _loss(yv, f[aside])
        if loss < best - 1e-6:
            best, kept, since = loss, [t.copy() for _, _, t in parts], 0
        else:
            since += 1
            if since >= PATIENCE:
                break
    for (_, bins, table), good in zip(parts, kept, strict=True):
        f += good[bins] - table[bins]
        table[...] = good
