"""SuperMinHash signatures of word shingle sets, in numpy, for a batch of documents at a time.

Element ``d`` of a set draws a random permutation of the ``m`` signature places and offers, to the place that comes
``j``-th in it, the value ``j + r`` with ``r`` uniform in [0, 1). A place keeps the smallest offer. Offers of round ``j``
can't beat a place that already holds a value below ``j``, so a document stops as soon as all of its places do. Ranks of
one element are without repetition, which is what lowers the variance below that of independent minima.
"""

import hashlib

import numpy as np

#: Values are kept as integers: the round in the upper 8 bits, the fraction in the lower 56.
ROUND = np.uint64(56)
FRACTION = np.uint64((1 << 56) - 1)
EMPTY = np.uint64((1 << 64) - 1)
#: Elements whose permutations are held at once: this many times ``m`` bytes.
ELEMENTS_AT_ONCE = 1 << 16


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word; remembers up to ``limit`` words, then starts anew."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= self.limit:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def shingle_set(text: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words of a text; of the whole text if it has fewer words.

    Words are what stands between the bytes 9 to 13 and 32; A-Z count as a-z.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(w))
    n = len(w) - width + 1
    h = np.full(n, width, np.uint64)
    for i in range(width):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[i : i + n])
    return np.unique(h)


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """One row of ``m`` values per set; an empty set's row is all ``EMPTY``."""
    out = np.full((len(sets), m), EMPTY, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return out
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
    _offer(out, elements, owner, 0, None)
    left = np.nonzero((sizes > 0) & (out.max(axis=1) > (np.uint64(1) << ROUND)))[0]
    # Documents that need more rounds are small: many elements fill all places in the first.
    start = 0
    while start < len(left):
        stop = start + max(1, int(np.searchsorted(np.cumsum(sizes[left[start:]]), ELEMENTS_AT_ONCE)))
        _more_rounds(out, sets, left[start:stop])
        start = stop
    return out


def _offer(out, elements, owner, j, order) -> None:
    m = out.shape[1]
    draw = mixed(elements + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    pick = j + ((draw >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
    if order is not None:
        rows = np.arange(len(elements))
        place = order[rows, pick].astype(np.int64)
        order[rows, pick] = order[:, j]
        order[:, j] = place
    else:
        place = pick
    value = (np.uint64(j) << ROUND) | (mixed(draw) & FRACTION)
    np.minimum.at(out.reshape(-1), owner * m + place, value)


def _more_rounds(out, sets, rows) -> None:
    m = out.shape[1]
    elements = np.concatenate([sets[i] for i in rows])
    owner = np.repeat(rows, [len(sets[i]) for i in rows])
    order = np.tile(np.arange(m, dtype=np.uint16), (len(elements), 1))
    for j in range(m):
        if j:
            _offer(out, elements, owner, j, order)
        else:  # the first round's offers are made; only its swap is missing
            draw = mixed(elements + np.uint64(0x9E3779B97F4A7C15))
            pick = ((draw >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            order[np.arange(len(elements)), pick] = 0
            order[:, 0] = pick
        open_ = out.max(axis=1) > (np.uint64(j + 1) << ROUND)
        keep = open_[owner]
        if not keep.any():
            return
        if not keep.all():
            elements, owner, order = elements[keep], owner[keep], order[keep]


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of each signature; equal bands at equal places have equal keys."""
    n, m = values.shape
    parts = values.reshape(n, bands, m // bands)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
    for i in range(parts.shape[2]):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def fingerprint(elements: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()
