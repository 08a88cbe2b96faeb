"""Hashes of runs of words, a whole text at a time."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that any of their bits can serve for order or choice."""
    x = x.copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of word runs: a polynomial over hashes of the words, by prefix sums.

    Each word is hashed by itself first, so that no structure of its letters carries over. The hash
    of any run then comes from two prefix sums: all runs of a text cost a few array steps.
    """

    def __init__(self) -> None:
        self.powers = np.ones(1, dtype=np.uint64)
        self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) >= size:
            return
        size = max(size, 2 * len(self.powers), 1 << 12)
        steps = np.full(size, _ODD, dtype=np.uint64)
        steps[0] = 1
        self.powers = np.cumprod(steps, dtype=np.uint64)
        steps[1:] = pow(_ODD, -1, 1 << 64) & _MASK
        self.inverses = np.cumprod(steps, dtype=np.uint64)

    def runs(self, words: list[bytes], length: int) -> np.ndarray:
        """The hash of every run of ``length`` words, by its first word; none if there are fewer."""
        count = len(words) - length + 1
        if count <= 0:
            return np.empty(0, dtype=np.uint64)
        self._grow(len(words) + 1)
        values = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(values * self.powers[: len(words)], out=sums[1:])
        return mix((sums[length:] - sums[:count]) * self.inverses[:count])


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words between ASCII white space, as UTF-8; ``lower`` lower-cases A-Z alone."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()
