"""Balanced parts of a neighbour graph, and a small classifier that tells how likely each part holds a vector's neighbours."""

import numpy as np

#: Neighbours by which sample vectors are linked, and for which the classifier is trained.
NEIGHBOURS = 10
#: Hidden units, passes over the sample, vectors of a step and step size of the classifier.
HIDDEN, PASSES, STEP_ROWS, RATE = 128, 40, 256, 0.003
#: Matrix products of a bisection, and rounds of swaps after it.
PRODUCTS, SWAPS = 60, 30


def nearest_rows(x: np.ndarray, of: np.ndarray, k: int, own: np.ndarray | None = None, block: int = 1024) -> np.ndarray:
    """Row numbers in ``x`` of the ``k`` nearest to each row of ``of``, without the row number that ``own`` names."""
    k = min(k, len(x) - (own is not None))
    out, squares = np.empty((len(of), k), np.int64), (x * x).sum(axis=1)
    for start in range(0, len(of), block):
        far = squares - 2 * of[start : start + block] @ x.T
        if own is not None:
            far[np.arange(len(far)), own[start : start + block]] = np.inf
        out[start : start + block] = np.argpartition(far, k - 1, axis=1)[:, :k] if k else 0
    return out


def _bisect(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which half (of equal size, up to one) each node of a graph goes to, with few edges a-b between the halves."""
    n = len(nodes)
    degree = np.maximum(np.bincount(a, minlength=n), 1).astype(float)
    # The slowest mode of a random walk on the graph is smooth along its edges: its median splits it with a small cut.
    v = rng.standard_normal(n)
    for _ in range(PRODUCTS):
        v = 0.5 * v + 0.5 * np.bincount(a, v[b], minlength=n) / degree
        v -= (v * degree).sum() / degree.sum()
        v /= np.linalg.norm(v) + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2 :]] = True
    cut, best = int((side[a] != side[b]).sum()), side.copy()
    for _ in range(SWAPS):  # swap pairs of nodes that have more edges across than within
        across = np.bincount(a, side[a] != side[b], minlength=n)
        gain = 2 * across - np.bincount(a, minlength=n) + 0.01 * rng.random(n)
        left, right = np.nonzero(~side)[0], np.nonzero(side)[0]
        left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
        m = min(len(left), len(right))
        pairs = int((gain[left[:m]] + gain[right[:m]] > 0).sum())
        if not pairs:
            break
        move = max(1, pairs // 4)  # not all, as neighbours would change places for ever
        side[left[:move]], side[right[:move]] = True, False
        now = int((side[a] != side[b]).sum())
        if now < cut:
            cut, best = now, side.copy()
    return best


def balanced_parts(neighbours: np.ndarray, parts: int, seed: int) -> np.ndarray:
    """Part (0 .. parts - 1, a power of two) of each node; parts differ by one node a level at most."""
    n, rng = len(neighbours), np.random.default_rng(seed)
    a = np.repeat(np.arange(n), neighbours.shape[1])
    edges = np.unique(np.concatenate([a * n + neighbours.reshape(-1), neighbours.reshape(-1) * n + a]))
    a, b = edges // n, edges % n
    part = np.zeros(n, np.int64)
    while parts > 1:
        parts //= 2
        split = np.zeros(n, np.int64)
        inner = part[a] == part[b]
        a, b = a[inner], b[inner]
        place = np.zeros(n, np.int64)
        for p in np.unique(part):
            nodes = np.nonzero(part == p)[0]
            place[nodes] = np.arange(len(nodes))
            mine = part[a] == p
            split[nodes] = _bisect(nodes, place[a[mine]], place[b[mine]], rng)
        part = 2 * part + split
    return part


class Router:
    """Probabilities of parts from a network with one hidden layer."""

    def __init__(self, x: np.ndarray, targets: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.scale = max(float(np.sqrt((x * x).mean())), 1e-300)
        d, m = x.shape[1], targets.shape[1]
        x = x / self.scale
        weights = [
            rng.standard_normal((d, HIDDEN)) * np.sqrt(2 / d),
            np.zeros(HIDDEN),
            rng.standard_normal((HIDDEN, m)) * np.sqrt(1 / HIDDEN),
            np.zeros(m),
        ]
        first, second, steps = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        rounds = PASSES * max(1, -(-len(x) // STEP_ROWS))
        for _ in range(PASSES):
            order = rng.permutation(len(x))
            for start in range(0, len(x), STEP_ROWS):
                rows = order[start : start + STEP_ROWS]
                hidden = np.maximum(x[rows] @ weights[0] + weights[1], 0)
                wrong = (_softmax(hidden @ weights[2] + weights[3]) - targets[rows]) / len(rows)
                back = (wrong @ weights[2].T) * (hidden > 0)
                gradients = [x[rows].T @ back, back.sum(axis=0), hidden.T @ wrong, wrong.sum(axis=0)]
                steps += 1
                rate = RATE * (1 - steps / (rounds + 1))
                for i, g in enumerate(gradients):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    fit = np.sqrt(second[i] / (1 - 0.999**steps)) + 1e-8
                    weights[i] = weights[i] - rate * first[i] / (1 - 0.9**steps) / fit
        self.weights = weights

    def __call__(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x / self.scale) @ self.weights[0] + self.weights[1], 0)
        return _softmax(hidden @ self.weights[2] + self.weights[3])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def part_shares(neighbours: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    """Share of each part among a vector's neighbours."""
    n, k = neighbours.shape
    cells = np.repeat(np.arange(n), k) * parts + part[neighbours].reshape(-1)
    return np.bincount(cells, minlength=n * parts).reshape(n, parts) / max(1, k)
