"""FM-index over a sequence of word numbers: wavelet-matrix ranks, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

SEPARATOR = 0
SAMPLE_EVERY = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order; a separator is less than any word and, by position, unlike any other separator.

    Prefix doubling: each round sorts only what earlier rounds left tied, by the rank of what follows.
    """
    n = len(text)
    apart = text == SEPARATOR
    rank = text.astype(np.int64) + int(apart.sum())
    rank[apart] = np.arange(int(apart.sum()))
    order = np.argsort(rank, kind="stable")
    keys = rank[order]
    group = np.concatenate([[True], keys[1:] != keys[:-1]])
    head = np.maximum.accumulate(np.where(group, np.arange(n), 0))
    rank[order] = head
    width = 1
    while True:
        tied = ~group
        tied[:-1] |= ~group[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        here = order[at]
        after = here + width
        follow = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        mine = rank[here]
        again = np.lexsort((follow, mine))
        order[at] = here[again]
        mine, follow = mine[again], follow[again]
        fresh = np.concatenate([[True], (mine[1:] != mine[:-1]) | (follow[1:] != follow[:-1])])
        group[at] = fresh
        start = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[order[at]] = start
        width *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, for many symbols and positions at once."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.ones, self.zeros, self.level = bits, [], [], []
        now = symbols.astype(np.int64)
        for b in range(bits - 1, -1, -1):
            bit = ((now >> b) & 1).astype(bool)
            ones = np.zeros(len(now) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.level.append(bit)
            self.ones.append(ones)
            self.zeros.append(len(now) - int(ones[-1]))
            now = np.concatenate([now[~bit], now[bit]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the first `upto` places."""
        start, end = np.zeros_like(upto), upto
        for k in range(self.bits):
            bit = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            a, b = self.ones[k][start], self.ones[k][end]
            start = np.where(bit, self.zeros[k] + a, start - a)
            end = np.where(bit, self.zeros[k] + b, end - b)
        return end - start

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before it."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for k in range(self.bits):
            bit = self.level[k][at]
            a, b = self.ones[k][start], self.ones[k][at]
            start = np.where(bit, self.zeros[k] + a, start - a)
            at = np.where(bit, self.zeros[k] + b, at - b)
            symbol = symbol * 2 + bit
        return symbol, at - start


class FmIndex:
    """Where phrases stand in a text of word numbers (1 to sigma - 1, SEPARATOR between runs, one at the end)."""

    def __init__(self, text: np.ndarray, sigma: int) -> None:
        order = suffix_array(text)
        before = text[order - 1]
        self.n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.ranks = WaveletMatrix(before, max(1, int(sigma - 1).bit_length()))
        self.sampled = (before == SEPARATOR) | (order % SAMPLE_EVERY == 0)
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of words the rows of suffixes that begin with it: from, to (equal where it is nowhere)."""
        m = len(phrases)
        low, high = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        live = np.arange(m)
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, j]
            a, b = (self.first[c] + self.ranks.rank(c, x[live]) for x in (low, high))
            low[live], high[live] = a, b
            live = live[a < b]
            if not len(live):
                break
        high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by steps back to the next sampled one."""
        out, at, todo, steps = np.zeros(len(rows), np.int64), rows.astype(np.int64), np.arange(len(rows)), 0
        while len(todo):
            done = self.sampled[at]
            out[todo[done]] = self.samples[self.sample_rank[at[done]]] + steps
            todo, at = todo[~done], at[~done]
            symbol, before = self.ranks.symbol_and_rank(at)
            at = self.first[symbol] + before
            steps += 1
        return out
