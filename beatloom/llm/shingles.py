"""Word shingles as 64-bit numbers and their MinHash values, in NumPy, for one text at a time."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_ROLL = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_CACHED_WORDS = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed five-word shingles. A text of one to four words is one shingle."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self._known: dict[str, int] = {}

    def _word(self, word: str) -> int:
        value = self._known.get(word)
        if value is None:
            if len(self._known) >= _CACHED_WORDS:
                self._known.clear()
            value = self._known[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes; none for a text without words."""
        words = (text or "").split()
        if not words:
            return np.empty(0, np.uint64)
        value = np.fromiter(map(self._word, words), np.uint64, len(words))
        width = min(self.words, len(words))
        rolled = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            rolled = rolled * _ROLL + value[k : len(words) - width + 1 + k]
        return np.unique(mixed(rolled))


class MinHash:
    """`size` 32-bit MinHash values: multiply-add over the mixed shingle, high half, minimum."""

    def __init__(self, size: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 64, size, np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 1 << 64, size, np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(shingles), 512):  # blocks stay in the processor's cache
            block = shingles[at : at + 512, None] * self.a + self.b
            np.minimum(out, (block >> np.uint64(32)).min(axis=0).astype(np.uint32), out=out)
        return out
