"""Hashes of runs of words, for many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

WORD_CACHE = 200_000
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
_SALT = np.uint64(0x165667B19E3779F9)
_HALF = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> _HALF)
    x *= _MIX_A
    x ^= x >> _HALF
    x *= _MIX_B
    x ^= x >> _HALF
    return x


class WordHashes(dict):
    """64-bit hash of each word; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(b: int) -> np.ndarray:
        values = np.full(size, b, np.uint64)
        values[0] = 1
        return np.multiply.accumulate(values)

    return powers(base), powers(pow(base, -1, 1 << 64))


class RunHashes:
    """64-bit hash of any run of neighbouring words, from sums over all words before it.

    ``which`` chooses between independent hashes.
    """

    def __init__(self, words: np.ndarray, which: int = 0) -> None:
        size = 1 << max(10, int(len(words)).bit_length())
        power, self.inverse = _powers(BASES[which], size)
        values = mix(words ^ (_SALT * np.uint64(which + 1)))
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(values * power[: len(words)], out=self.sums[1:])

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        inside = self.sums[starts + lengths] - self.sums[starts]
        return mix(inside * self.inverse[starts] + np.asarray(lengths).astype(np.uint64))
