"""FM-index over the words of one shard of texts, in numpy."""

from __future__ import annotations

import numpy as np

#: Every so many text positions one suffix position is kept.
SAMPLE = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order; needs a last symbol in every repeat's way to end.

    Ranks by the first h symbols give ranks by 3h (2h for long texts) by sorting on groups
    of ranks; only suffixes that still tie with others are sorted again.
    """
    n = len(symbols)
    parts = 3 if n < 1 << 21 else 2
    bits = 21 if parts == 3 else 31
    rank = np.zeros(n + 1, np.int64)
    rank[:n] = symbols + 1
    slots, at, order, h = np.arange(n), np.arange(n), np.empty(n, np.int64), 1
    # Symbols may be sparse; their ranks are the slots where their groups begin.
    while len(slots):
        key = rank[at]
        for k in range(1, parts):
            key = (key << bits) | rank[np.minimum(at + k * h, n)]
        by = np.argsort(key)
        key, at = key[by], at[by]
        new = np.empty(len(key), bool)
        new[0] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        order[slots] = at
        head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        rank[at] = slots[head] + 1
        alone = new & np.append(new[1:], True)
        slots, at, h = slots[~alone], at[~alone], h * parts
    return order


class WaveletMatrix:
    """Ranks of symbols by one bit vector per bit of a symbol, highest bit first."""

    def __init__(self, values: np.ndarray, size: int) -> None:
        self.bits = max(1, int(size - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            up = bit.astype(bool)
            values = np.concatenate([values[~up], values[up]])
        self.first = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            up = ((symbols >> (self.bits - 1 - level)) & 1).astype(bool)
            n = ones[at]
            at = np.where(up, zeros + n, at - n)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._down(symbols, at) - self.first[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places, and how often they occur before."""
        symbols = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            n = ones[at]
            up = ones[at + 1] > n
            at = np.where(up, zeros + n, at - n)
            symbols = symbols * 2 + up
        return symbols, at - self.first[symbols]


class FMIndex:
    """Search and locate phrases in texts given as one array of symbols.

    Symbol 0 ends each text; words are 1 to size - 1.
    """

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        n = len(symbols)
        ends = np.flatnonzero(symbols == 0)
        # Each end differs from all others, so that no repeat goes on behind a text.
        distinct = symbols + len(ends)
        distinct[ends] = np.arange(len(ends))
        order = suffix_order(distinct)
        self.start = np.zeros(size + 1, np.int64)
        np.cumsum(np.bincount(symbols, minlength=size), out=self.start[1:])
        before = np.where(order > 0, symbols[order - 1], 0)
        self.last = WaveletMatrix(before, size)
        begins = np.zeros(n + 1, bool)
        begins[0] = True
        begins[ends + 1] = True
        self.kept = (order % SAMPLE == 0) | begins[order]
        self.nth = np.zeros(n + 1, np.int32)
        np.cumsum(self.kept, out=self.nth[1:])
        self.samples = order[self.kept].astype(np.int32)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of suffixes that begin with each phrase (one per line), by backward search."""
        low = np.zeros(len(phrases), np.int64)
        high = np.zeros(len(phrases), np.int64)
        live = np.arange(len(phrases))
        lo, hi = self.start[phrases[:, -1]], self.start[phrases[:, -1] + 1]
        for column in range(phrases.shape[1] - 2, -1, -1):
            some = hi > lo
            live, lo, hi = live[some], lo[some], hi[some]
            word = phrases[live, column]
            base = self.start[word]
            lo, hi = base + self.last.rank(word, lo), base + self.last.rank(word, hi)
        low[live], high[live] = lo, hi
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back through the text to the next kept position."""
        found = np.empty(len(rows), np.int64)
        which, steps = np.arange(len(rows)), 0
        while len(rows):
            kept = self.kept[rows]
            found[which[kept]] = self.samples[self.nth[rows[kept]]] + steps
            which, rows = which[~kept], rows[~kept]
            symbols, before = self.last.access(rows)
            rows, steps = self.start[symbols] + before, steps + 1
        return found
