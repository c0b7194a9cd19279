"""Gap-weighted subsequence kernel of words, Nyström features and a linear support vector machine on them.

The kernel counts common subsequences of three characters; each occurrence weighs ``DECAY`` to the power of the stretch
that it covers, and stretches are at most ``SPAN`` characters, so that a character put in between or left out costs a
factor and not the match. Kernels are normalised: a word has 1 with itself.

Explicitly, a word is a sparse vector with an entry per character triple. A function learned on kernel values with
landmark words is linear in that vector, so it is folded into one table with a number per triple: scoring a word looks up
its triples and never compares it with a landmark.
"""

import re
from itertools import combinations

import numpy as np

from flowgauge.llm.super_minhash import mixed

DECAY, SPAN = 0.6, 6
#: Triples of whole code points are hashed to this many places: of the some 50,000 that words of a few languages show, one in
#: forty or so shares its place with another.
BITS = 20
TRIPLES = 1 << BITS
#: Longer words are scored piece by piece, so that every piece has a norm of its own.
PIECE = 24
#: Offsets of the second and third character of a subsequence, and its weight.
_SHAPES = [(j, k, DECAY ** (k + 1)) for j, k in combinations(range(1, SPAN), 2)]
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_SPACED = re.compile(r"(?<!\S)\w(?:[\s.*_-]{1,2}\w){2,}(?!\w)")


def words_of(text: str) -> set[str]:
    """Distinct lower-case words of a text, and words that are spelled with spaces or marks between their letters."""
    low = text.lower()
    out = set(low.split())
    for spelled in _SPACED.findall(low):
        out.add(re.sub(r"[\W_]+", "", spelled))
    return out


def normal(word: str) -> str:
    """Without marks at its ends; those inside stay, as characters that the kernel passes over at a cost."""
    return _EDGES.sub("", word)


def pieces(word: str) -> list[str]:
    """The word, or overlapping pieces of a very long one: every stretch of SPAN characters lies in one of them."""
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - SPAN, PIECE - SPAN)]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, triple, weight) of the normalised vectors of all words, sorted; words under 3 characters have none.

    Ends of words are part of them: a word stands between two marks.
    """
    framed = [f"^{w}$" for w in words]
    sizes = np.array([len(w) for w in framed], np.int64)
    text = "".join(framed)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words), dtype=np.int64), sizes)
    keys, weights = [], []
    for j, k, weight in _SHAPES:
        if len(code) <= k:
            continue
        inside = owner[k:] == owner[:-k]
        stop = len(code) - k
        whole = (code[:stop] << np.uint64(42)) | (code[j : j + stop] << np.uint64(21)) | code[k:]
        triple = (mixed(whole[inside]) >> np.uint64(64 - BITS)).astype(np.int64)
        keys.append(owner[:stop][inside] * TRIPLES + triple)
        weights.append(np.full(int(inside.sum()), weight))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    flat, back = np.unique(np.concatenate(keys), return_inverse=True)
    weight = np.bincount(back, np.concatenate(weights), minlength=len(flat))
    word, triple = flat // TRIPLES, flat % TRIPLES
    norm = np.sqrt(np.bincount(word, weight**2, minlength=len(words)))
    return word, triple, weight / norm[word]


def table_values(words: list[str], table: np.ndarray) -> np.ndarray:
    """Inner product of every word's vector with the table."""
    word, triple, weight = triples(words)
    return np.bincount(word, weight * table[triple], minlength=len(words))


class Landmarks:
    """Nyström features of words: kernel values with landmark words, whitened."""

    def __init__(self, words: list[str]):
        word, triple, weight = triples(words)
        self.known, place = np.unique(triple, return_inverse=True)
        self.vectors = np.zeros((len(words), len(self.known)))
        self.vectors[word, place] = weight
        values, axes = np.linalg.eigh(self.vectors @ self.vectors.T)
        good = values > 1e-6 * max(values.max(initial=0), 1e-12)
        self.whiten = axes[:, good] / np.sqrt(values[good])

    def features(self, words: list[str], at_once: int = 256) -> np.ndarray:
        out = np.zeros((len(words), self.whiten.shape[1]), np.float32)
        turned = (self.vectors.T @ self.whiten).astype(np.float32)  # by triple
        for start in range(0, len(words), at_once):
            word, triple, weight = triples(words[start : start + at_once])
            place = np.searchsorted(self.known, triple)
            hit = np.nonzero(place < len(self.known))[0]
            hit = hit[self.known[place[hit]] == triple[hit]]
            if len(hit):
                rows = turned[place[hit]] * weight[hit, None].astype(np.float32)
                first = np.nonzero(np.r_[True, np.diff(word[hit]) > 0])[0]
                out[start + word[hit][first]] = np.add.reduceat(rows, first)
        return out

    def table(self, direction: np.ndarray) -> np.ndarray:
        """The linear function on the features as one number per triple."""
        out = np.zeros(TRIPLES)
        out[self.known] = self.vectors.T @ (self.whiten @ direction)
        return out


def fit_svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss in the primal, by Newton steps on the rows inside the margin.

    ``y`` is -1 or 1. The intercept is not penalised.
    """
    penalty = np.diag(np.r_[np.full(z.shape[1], ridge), 1e-9])
    w, active = np.zeros(z.shape[1] + 1), None

    def margins(w: np.ndarray) -> np.ndarray:
        return y * (z @ w[:-1].astype(z.dtype) + w[-1])

    def loss(w: np.ndarray) -> float:
        return float((weight * np.maximum(0, 1 - margins(w)) ** 2).sum() + w @ penalty @ w)

    for _ in range(steps):
        now = margins(w) < 1
        if active is not None and (now == active).all():
            break
        active = now
        left, right = penalty.copy(), np.zeros(len(w))
        rows = np.nonzero(active)[0]
        for start in range(0, len(rows), 4096):
            some = rows[start : start + 4096]
            x = np.hstack([z[some].astype(np.float64), np.ones((len(some), 1))])
            weighed = x * weight[some, None]
            left += weighed.T @ x
            right += weighed.T @ y[some]
        target = np.linalg.solve(left, right)
        # Halve the step until the loss falls.
        before, scale = loss(w), 1.0
        while scale > 1e-3 and loss(w + scale * (target - w)) > before:
            scale /= 2
        w = w + scale * (target - w)
    return w[:-1], float(w[-1])
