"""Words of a text as 64-bit numbers, for the operators that compare runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

from clickweave.llm.common import WordCache

U64 = np.uint64


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` odd multipliers made from a seed."""
    return np.array([xxhash.xxh3_64_intdigest(str(i).encode(), seed) | 1 for i in range(n)], U64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over all; one to one."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def hash_cache(limit: int = 300_000) -> WordCache:
    return WordCache(xxhash.xxh3_64_intdigest, limit)


def hashes(words: list[bytes], cache: WordCache) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), U64, len(words))


def window_hashes(words: np.ndarray, places: tuple[int, ...], seed: int) -> np.ndarray:
    """One number for each window, of the words at ``places`` from its start."""
    n = len(words) - places[-1]
    if n <= 0:
        return np.empty(0, U64)
    total = np.zeros(n, U64)
    for place, factor in zip(places, odd_numbers(len(places), seed)):
        total += words[place:place + n] * factor
    return mix(total)
