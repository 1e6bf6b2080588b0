"""An FM-index over whole numbers: wavelet-tree ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

#: Every so many positions of the text keep their place in the suffix array.
SAMPLE = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order; a suffix that is a prefix of another is first.

    Prefixes of two symbols are ranked, then of four, and so on; only suffixes that still
    share their rank with another one are sorted again.
    """
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int64)
    rank = text.astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    sorted_rank = rank[order]
    head = np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    while True:
        tied = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
        if not len(tied):
            return order
        position = order[tied]
        ahead = position + step
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[position] * (n + 2) + follow
        resorted = np.argsort(key, kind="stable")
        order[tied], key = position[resorted], key[resorted]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        head[tied] |= fresh
        rank[order[tied]] = np.maximum.accumulate(np.where(fresh, tied, 0))
        step *= 2


class WaveletTree:
    """Ranks of any symbol in any prefix of a sequence, one bit row for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` occurs before place ``upto``."""
        low, high = np.zeros_like(upto), upto
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            low_ones, high_ones = ones[low], ones[high]
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return high - low

    def symbol(self, place: np.ndarray) -> np.ndarray:
        """The symbols at ``place``."""
        found = np.zeros(len(place), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            one = ones[place + 1] - ones[place]
            found = found * 2 + one
            place = np.where(one == 1, zeros + ones[place], place - ones[place])
        return found


class FMIndex:
    """Finds every occurrence of many patterns at once. Symbols are at least 1."""

    def __init__(self, text: np.ndarray, bits: int) -> None:
        text = np.concatenate([text, [0]])
        places = suffix_array(text)
        self.last = WaveletTree(text[places - 1], bits)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        kept = places % SAMPLE == 0
        self.kept_before = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
        self.sampled = places[kept].astype(np.int32)
        self.size = len(text)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the suffixes that begin with each row of ``patterns``."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        alive = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, k]
            low[alive] = self.smaller[symbol] + self.last.rank(symbol, low[alive])
            high[alive] = self.smaller[symbol] + self.last.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to a sampled one, counting the steps."""
        found = np.full(len(rows), -1, np.int64)
        alive, steps = np.arange(len(rows)), 0
        while len(alive):
            row = rows[alive]
            kept = self.kept_before[row + 1] > self.kept_before[row]
            found[alive[kept]] = self.sampled[self.kept_before[row[kept]]] + steps
            alive, row, steps = alive[~kept], row[~kept], steps + 1
            symbol = self.last.symbol(row)
            rows = rows.copy() if steps == 1 else rows
            rows[alive] = self.smaller[symbol] + self.last.rank(symbol, row)
        return found
