"""An FM-index over word ids, as arrays, with bidirectional extension of many intervals at once.

A text is an array of symbols, 0 between its pieces and at its end. Its rotations are sorted by
their first ``depth`` symbols; a phrase of that many symbols or fewer is an interval of them, the
rotations that begin with it. ``bwt`` has the symbol before each rotation. Going through it by symbol
(``_by``, the inverse of the last-to-first mapping) all phrases one symbol longer to the left come as
runs, and a run's place there is the longer phrase's interval: C of the symbol, plus the rank of the
symbol at the interval's ends.

``Bidirectional`` keeps an index of the text and one of its reverse, and every phrase's interval in
both, so that phrases grow to the left and to the right.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_LOW = np.int64(0xFFFF)


def stable_order(values: np.ndarray) -> np.ndarray:
    """``argsort(kind='stable')`` of numbers from 0 to 2**32, 16 bits at a time, as numpy counts those."""
    order = np.argsort((values & _LOW).astype(np.uint16), kind="stable")
    if len(values) and int(values.max()) > 0xFFFF:
        order = order[np.argsort((values[order] >> 16).astype(np.uint16), kind="stable")]
    return order


class Runs(NamedTuple):
    """Phrases one symbol longer: the symbol, the number of the phrase they come from, the interval, and
    how many rotations of that phrase's interval have a smaller symbol there."""

    symbol: np.ndarray
    parent: np.ndarray
    low: np.ndarray
    size: np.ndarray
    before: np.ndarray


class FMIndex:
    def __init__(self, text: np.ndarray, depth: int) -> None:
        n = len(text)
        order = np.arange(n)
        for _ in range(depth):
            order -= 1
            order[order < 0] += n
            order = order[stable_order(text[order])]
        self.order = order
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1))])
        bwt = text[order - 1]
        self._by = stable_order(bwt)
        self._symbols = bwt[self._by]

    def rank(self, symbol: int, row: int) -> int:
        """How often the symbol occurs in the BWT above the row."""
        low, high = self.starts[symbol], self.starts[symbol + 1]
        return int(np.searchsorted(self._by[low:high], row))

    def find(self, phrase: list[int]) -> tuple[int, int]:
        """The interval of a phrase of up to ``depth`` symbols, by backward search."""
        low, high = 0, len(self.order)
        for symbol in reversed(phrase):
            start = int(self.starts[symbol])
            low, high = start + self.rank(symbol, low), start + self.rank(symbol, high)
        return low, high

    def extend(self, low: np.ndarray, size: np.ndarray) -> Runs:
        """All phrases one symbol longer to the left than those of the given disjoint intervals; none goes over a 0."""
        of_row = np.full(len(self.order), -1)
        of_row[np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.repeat(np.arange(len(low)), size)
        parents = of_row[self._by]
        kept = np.flatnonzero(parents >= 0)
        symbols, parents = self._symbols[kept], parents[kept]
        if not len(kept):
            none = np.zeros(0, np.int64)
            return Runs(none, none, none, none, none)
        new = np.flatnonzero(np.concatenate([[True], (symbols[1:] != symbols[:-1]) | (parents[1:] != parents[:-1])]))
        sizes = np.diff(np.append(new, len(kept)))
        symbol, parent = symbols[new], parents[new]
        by_parent = np.argsort(parent, kind="stable")  # and by symbol, as runs come
        above = np.cumsum(sizes[by_parent]) - sizes[by_parent]
        first = np.searchsorted(parent[by_parent], np.arange(len(low)))
        before = np.empty_like(sizes)
        before[by_parent] = above - above[first[parent[by_parent]]]
        words = symbol > 0
        return Runs(symbol[words], parent[words], kept[new][words], sizes[words], before[words])


class Phrases(NamedTuple):
    """Phrases of one length with their intervals in both indexes."""

    low: np.ndarray
    reverse_low: np.ndarray
    size: np.ndarray
    symbol: np.ndarray  # what was added to the parent
    parent: np.ndarray

    def where(self, kept: np.ndarray) -> Phrases:
        return Phrases(*(column[kept] for column in self))


class Bidirectional:
    """``text`` has 0 at its end and between pieces. Phrases of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int) -> None:
        self.text = text
        self.forward = FMIndex(text, depth)
        self.reverse = FMIndex(text[::-1].copy(), depth - 1)

    def words(self) -> Phrases:
        starts = self.forward.starts
        symbol = np.arange(1, len(starts) - 1)
        return Phrases(starts[1:-1], starts[1:-1], np.diff(starts)[1:], symbol, np.full(len(symbol), -1))

    def left(self, phrases: Phrases) -> Phrases:
        runs = self.forward.extend(phrases.low, phrases.size)
        return Phrases(runs.low, phrases.reverse_low[runs.parent] + runs.before, runs.size, runs.symbol, runs.parent)

    def right(self, phrases: Phrases) -> Phrases:
        runs = self.reverse.extend(phrases.reverse_low, phrases.size)
        return Phrases(phrases.low[runs.parent] + runs.before, runs.low, runs.size, runs.symbol, runs.parent)

    def place(self, phrases: Phrases) -> np.ndarray:
        """Where in the text one occurrence of each phrase begins."""
        return self.forward.order[phrases.low]

    def suffix_of(self, longer: Phrases, phrases: Phrases) -> np.ndarray:
        """The number of the phrase of ``phrases`` that each longer one ends with, or -1."""
        order = np.argsort(phrases.reverse_low)
        at = np.searchsorted(phrases.reverse_low[order], longer.reverse_low, "right") - 1
        found = order[np.maximum(at, 0)] if len(order) else np.zeros(len(longer.low), np.int64)
        if not len(order):
            return found - 1
        inside = (at >= 0) & (longer.reverse_low < phrases.reverse_low[found] + phrases.size[found])
        return np.where(inside, found, -1)
