"""Nearest entries of a small codebook of integer vectors by a geometric near-neighbour access tree."""

import numpy as np

#: Split points of a node; a node with no more entries than that is a leaf.
DEGREE = 8
#: Square roots are off by less than this share of themselves.
_SLACK = 2.0**-50


def _below(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * (1 - _SLACK)


def _above(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * (1 + _SLACK)


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of all rows of both, as integers."""
    out = np.zeros((len(x), len(y)), np.int64)
    for c in range(x.shape[1]):
        step = x[:, c, None] - y[None, :, c]
        out += step * step
    return out


class Gnat:
    """Entries below split points that lie far apart; each entry is in the child of its nearest split point.

    For every split point and child the node holds the least and the greatest distance between the point and the child's
    entries. By the triangle inequality, a query whose distance to the point is too far outside that range can't be nearer
    to any entry of the child than what it has found: the whole child is left out. It is left out only if the bound is
    strictly above the distance found, with all roots rounded to the safe side, so that a tie is always looked at; ties are
    told by integers, to the lower index.
    """

    def __init__(self, entries: np.ndarray, indexes: np.ndarray | None = None, total: int | None = None):
        self.entries = entries
        self.indexes = np.arange(len(entries)) if indexes is None else indexes
        self.total = len(entries) if total is None else total
        self.children: list[Gnat] = []
        self.compared = 0  # distances taken
        if len(entries) <= DEGREE:
            self.points, self.point_indexes = entries, self.indexes
            return
        chosen, nearest = [0], squares(entries, entries[:1])[:, 0]
        while len(chosen) < DEGREE and nearest.max() > 0:  # the entry farthest from those chosen
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squares(entries, entries[chosen[-1:]])[:, 0])
        self.points, self.point_indexes = entries[chosen], self.indexes[chosen]
        distances = squares(entries, self.points)
        rest = np.ones(len(entries), bool)
        rest[chosen] = False
        home = np.where(rest, distances.argmin(axis=1), -1)
        if not distances.any():  # all alike: the lowest index stands for them
            keep = np.array([self.indexes.argmin()])
            self.points, self.point_indexes = entries[keep], self.indexes[keep]
            return
        ranges = []
        for j in range(len(chosen)):
            mine = home == j
            if mine.any():
                self.children.append(Gnat(entries[mine], self.indexes[mine], self.total))
                ranges.append((j, _below(distances[mine].min(axis=0)), _above(distances[mine].max(axis=0))))
        self.home = np.full(len(chosen), -1)  # child of a split point
        self.home[[j for j, _, _ in ranges]] = np.arange(len(ranges))
        self.low = np.array([low for _, low, _ in ranges]).reshape(-1, len(chosen))
        self.high = np.array([high for _, _, high in ranges]).reshape(-1, len(chosen))

    def _improve(self, x: np.ndarray, best: np.ndarray) -> None:
        """Lower ``best`` (squared distance * number of entries + index) where this subtree has something better."""
        found = squares(x, self.points)
        self.compared += found.size
        np.minimum(best, (found * self.total + self.point_indexes).min(axis=1), out=best)
        if not self.children:
            return
        near, far = _below(found), _above(found)
        first = self.home[found.argmin(axis=1)]  # the nearest point's child most likely has the best
        for own in (True, False):
            for j, child in enumerate(self.children):
                rows = np.nonzero((first == j) == own)[0]
                # Roots are of whole distances; differences of roots are rounded once more, to the safe side.
                reach = _above(best[rows] // self.total)[:, None]
                beyond = np.nextafter(near[rows] - self.high[j], -np.inf) > reach
                within = np.nextafter(self.low[j] - far[rows], -np.inf) > reach
                rows = rows[~(beyond | within).any(axis=1)]
                if len(rows):
                    some = best[rows]
                    child._improve(x[rows], some)
                    best[rows] = some

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each row's nearest entry."""
        best = np.full(len(x), np.iinfo(np.int64).max)
        self._improve(x, best)
        return best % self.total, best // self.total

    def comparisons(self) -> int:
        """Distances that all searches so far have taken."""
        return self.compared + sum(c.comparisons() for c in self.children)
