"""Sets of word shingles, their MinHash signatures, and the exact comparison of two sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LANES = 32  # numbers of 16 bits in a signature
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Shingles:
    """Sets of 64-bit hashes of a text's lower-cased (A-Z) word shingles. Hashes of short words are remembered, at
    most ``cache`` of them; the memory restarts when full."""

    def __init__(self, words: int, cache: int = 300_000):
        import xxhash

        self.words, self.digest = words, xxhash.xxh3_64_intdigest
        outer = self

        class Known(dict):
            def __missing__(self, word):
                h = outer.digest(word)
                if len(word) <= 32:
                    if len(self) >= cache:
                        self.clear()
                    self[word] = h
                return h

        self.known = Known()

    def __call__(self, text: bytes) -> np.ndarray:
        """Ascending distinct hashes; fewer words than a shingle has are one, no words none."""
        words = text.lower().split()
        n = len(words) - self.words + 1
        if n < 1:
            return np.array([self.digest(b" ".join(words), seed=len(words))] if words else [], np.uint64)
        w = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        h = w[:n].copy()
        for i in range(1, self.words):
            h = mix(h) * ODD + w[i : n + i]
        return np.unique(mix(h))


def signatures(sets: list[np.ndarray], lanes: int = LANES, bits: int = 16, most: int = 1 << 19) -> np.ndarray:
    """The sets' signatures: for each lane ``bits`` bits of the set's least number under the lane's bijection; zeros for
    an empty set. Sets are taken together up to about ``most`` hashes."""
    out = np.zeros((len(sets), lanes), np.uint16 if bits > 8 else np.uint8)
    turns = mix((np.arange(2 * lanes, dtype=np.uint64) + np.uint64(lanes << 20)) * ODD)
    ends = np.cumsum([len(s) for s in sets])
    filled = np.flatnonzero([len(s) for s in sets])
    for part in np.split(filled, np.flatnonzero(np.diff(ends[filled] // most)) + 1) if len(filled) else ():
        flat = np.concatenate([sets[i] for i in part])
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in part])[:-1]])
        for k in range(lanes):
            least = np.minimum.reduceat((flat ^ turns[k]) * (turns[lanes + k] | np.uint64(1)), starts)
            out[part, k] = mix(least) >> np.uint64(64 - bits)
    return out


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * shared hashes reach ``percent`` * all hashes of two sets."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


class Groups:
    """Groups of a cell's members. Only pairs whose whole sets are alike join two groups; pairs inside a group are passed
    over, so a crowd of copies costs about one comparison a member."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.label = np.arange(len(sets))

    def join(self, a: np.ndarray, b: np.ndarray, differ: np.ndarray):
        """Compares pairs, the most alike signatures first; gives those that joined two groups."""
        apart = np.flatnonzero(self.label[a] != self.label[b])
        for k in apart[np.argsort(differ[apart], kind="stable")].tolist():
            x, y = int(a[k]), int(b[k])
            low, high = sorted((int(self.label[x]), int(self.label[y])))
            if low != high and alike(self.sets[x], self.sets[y], self.percent):
                self.label[self.label == high] = low
                yield x, y
