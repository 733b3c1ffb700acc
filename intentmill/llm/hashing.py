"""Words of a text as numbers, and numbers of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words given as bytes; remembers a bounded number of them."""

    def __init__(self, remembered: int = 1_000_000):
        self.known: dict[bytes, int] = {}
        self.remembered = remembered

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        found = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > self.remembered:
            known.clear()
        return found


def runs(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of every n words in a row."""
    count = len(hashes) - n + 1
    total = np.zeros(max(count, 0), np.uint64)
    if count > 0:
        factor = mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) | np.uint64(1)
        for i in range(n):
            total += hashes[i : i + count] * factor[i]
    return mixed(total)
