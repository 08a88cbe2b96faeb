"""Run-length grammars by recompression, and longest common extensions read from them."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Step(NamedTuple):
    """How one level's symbols make up the next one's: runs of a symbol, or pairs of two."""

    symbols: np.ndarray
    parent: np.ndarray  # for every symbol, the symbol above that holds it
    first: np.ndarray  # for every symbol above, its first symbol here; one more entry for the end
    runs: bool

    def mirrored(self) -> Step:
        above = len(self.first) - 2
        return Step(
            self.symbols[::-1], above - self.parent[::-1], len(self.symbols) - self.first[::-1], self.runs
        )


class Grammar:
    """A run-length grammar of a sequence, in levels.

    Levels are made by turns: maximal runs of one symbol become a symbol, then symbols are split
    into left and right ones, and every left one before a right one becomes a symbol with it. Equal
    stretches get equal symbols but at their ends, so two positions are compared a symbol at a time:
    up the levels while symbols agree, down into the first ones that differ, with one step at most
    on each level. Levels are made as far up as the comparisons go.

    The last symbol, and the first, must occur once: no extension then passes an end.
    """

    def __init__(self, sequence: np.ndarray) -> None:
        self._top = np.asarray(sequence, dtype=np.int64)
        self._next_id = int(self._top.max()) + 1
        self._steps: list[Step] = []
        self._mirrored: list[Step] = []

    def _step(self, level: int, mirrored: bool) -> Step:
        while len(self._steps) <= level:
            for made in (self._compress_runs(), self._compress_pairs()):
                self._steps.append(made)
                self._mirrored.append(made.mirrored())
        return (self._mirrored if mirrored else self._steps)[level]

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """New symbols, equal for equal keys."""
        distinct, names = np.unique(keys, return_inverse=True)
        names = names + self._next_id
        self._next_id += len(distinct)
        return names

    def _compress_runs(self) -> Step:
        below = self._top
        first = np.concatenate(([0], np.flatnonzero(below[1:] != below[:-1]) + 1, [len(below)]))
        lengths = np.diff(first)
        above = below[first[:-1]].copy()
        long = np.flatnonzero(lengths > 1)
        if len(long):
            above[long] = self._named(above[long] * (int(lengths.max()) + 1) + lengths[long])
        parent = np.repeat(np.arange(len(above)), lengths)
        self._top = above
        return Step(below, parent, first, runs=True)

    def _compress_pairs(self) -> Step:
        """Of several ways to split the symbols, left and right, the one with most pairs."""
        below = self._top
        best: np.ndarray = np.empty(0, dtype=np.int64)
        spread = below.astype(np.uint64) * _ODD
        spread ^= spread >> np.uint64(29)
        shift = len(self._steps)
        while not len(best) and len(below) > 1:
            factor = np.uint64((2 * shift + 1) * 0xD6E8FEB86659FD93 & (2**64 - 1))
            right = (spread * factor) >> np.uint64(63) != 0
            first, second = right[:-1], right[1:]
            best = max(np.flatnonzero(~first & second), np.flatnonzero(first & ~second), key=len)
            shift += 1
        above = below.copy()
        if len(best):
            above[best] = self._named(below[best] * self._next_id + below[best + 1])
        kept = np.ones(len(below), dtype=bool)
        kept[best + 1] = False
        first = np.concatenate((np.flatnonzero(kept), [len(below)]))
        self._top = above[kept]
        return Step(below, np.cumsum(kept) - 1, first, runs=False)

    def extensions(self, a: np.ndarray, b: np.ndarray, backwards: bool = False) -> np.ndarray:
        """How many symbols agree from positions ``a`` and ``b`` on (before them, if ``backwards``).

        For each i, ``a[i]`` and ``b[i]`` differ. Backwards, where neither is 0, a - 1 and b - 1 come first.
        """
        a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
        if not len(a):
            return np.zeros(0, dtype=np.int64)
        if backwards:
            size = len(self._step(0, True).symbols)
            a, b = size - a, size - b
        start = a
        # Up: what is still equal, and where on each level the others were found to differ.
        differ: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        which = np.arange(len(a))
        level = 0
        while True:
            step = self._step(level, backwards)
            same = step.symbols[a] == step.symbols[b]
            found = [(which[~same], a[~same], b[~same])]
            which, a, b = which[same], a[same], b[same]
            above_a, above_b = step.parent[a], step.parent[b]
            starts = (step.first[above_a] == a) & (step.first[above_b] == b)
            # Where one is inside its symbol above, both go on to the symbol after.
            rest_a, rest_b = step.first[above_a + 1] - a, step.first[above_b + 1] - b
            if step.runs:
                unequal = rest_a != rest_b
                shorter = np.minimum(rest_a, rest_b)[unequal]
                found.append((which[unequal], a[unequal] + shorter, b[unequal] + shorter))
                go = ~unequal
                which, above_a, above_b, starts = which[go], above_a[go], above_b[go], starts[go]
            above_a, above_b = np.where(starts, above_a, above_a + 1), np.where(starts, above_b, above_b + 1)
            differ.append(tuple(np.concatenate(parts) for parts in zip(*found, strict=True)))
            a, b = above_a, above_b
            if not len(which):
                break
            level += 1
        # Down: into the first symbols that differ, past what these have in common.
        which, a, b = differ[-1]
        for level in range(len(differ) - 2, -1, -1):
            step = self._step(level, backwards)
            end_a, end_b = step.first[a + 1], step.first[b + 1]
            a, b = step.first[a], step.first[b]
            same = step.symbols[a] == step.symbols[b]
            past = np.minimum(end_a - a, end_b - b) if step.runs else 1
            a, b = a + same * past, b + same * past
            which, a, b = (np.concatenate(pair) for pair in zip((which, a, b), differ[level], strict=True))
        reached = np.empty(len(start), dtype=np.int64)
        reached[which] = a
        return reached - start
