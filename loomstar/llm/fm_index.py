"""An FM-index over a sequence of word numbers, in numpy: searches many phrases at once and locates where they occur."""

from __future__ import annotations

import numpy as np

#: Every how many words of a run the position of a suffix is kept; between them it is walked to.
SAMPLE = 8


class WaveletMatrix:
    """Rank of symbols in a sequence: how often ``c`` stands before position ``i``."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (values >> level) & 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=before[1:])
            self.ones.append(before)
            self.zeros.append(len(values) - int(before[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        low = np.zeros(len(symbol), np.int64)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            set_ = ((symbol >> level) & 1).astype(bool)
            ones = self.ones[k]
            low = np.where(set_, self.zeros[k] + ones[low], low - ones[low])
            at = np.where(set_, self.zeros[k] + ones[at], at - ones[at])
        return at - low


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by doubling; once an order is settled only the ties are sorted again."""
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    sorted_ranks = ranks[order]
    head = np.ones(n, bool)
    head[1:] = sorted_ranks[1:] != sorted_ranks[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    length = 1
    while not head.all():
        tied = ~head
        tied[:-1] |= ~head[1:]
        slots = np.flatnonzero(tied)
        rows = order[slots]
        ahead = rows + length
        following = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        by = np.lexsort((following, rank[rows]))
        rows, following = rows[by], following[by]
        order[slots] = rows
        same = np.zeros(len(rows), bool)
        same[1:] = (rank[rows][1:] == rank[rows][:-1]) & (following[1:] == following[:-1])
        head[slots] = ~same
        starts = np.flatnonzero(head)
        rank[order[slots]] = starts[np.searchsorted(starts, slots, side="right") - 1]
        length *= 2
    return order


class FMIndex:
    """Over runs of symbols 1..``symbols``-1, each run closed by a 0. No phrase contains 0."""

    def __init__(self, values: np.ndarray, symbols: int):
        n = len(values)
        ends = np.flatnonzero(values == 0)
        ranks = values.astype(np.int64) + len(ends)  # each end sorts apart from the others, before all words
        ranks[ends] = np.arange(len(ends))
        order = suffix_order(ranks)
        before = np.where(order > 0, values[order - 1], 0)
        self.tree = WaveletMatrix(before, symbols)
        count = np.bincount(values, minlength=symbols)
        self.first = np.concatenate([[0], np.cumsum(count)])
        self.before = before
        in_run = np.arange(n) - np.repeat(np.concatenate([[0], ends[:-1] + 1]), np.diff(np.concatenate([[-1], ends])))
        self.sampled = (in_run % SAMPLE == 0)[order]  # run starts among them, so no walk leaves its run
        self.place = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-but-one row of the suffixes that begin with each phrase (int[phrases, words]), by backward search."""
        n = len(phrases)
        low, high, open_ = np.zeros(n, np.int64), np.full(n, len(self.before), np.int64), np.arange(n)
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[open_, k]
            low[open_] = self.first[symbol] + self.tree.rank(symbol, low[open_])
            high[open_] = self.first[symbol] + self.tree.rank(symbol, high[open_])
            open_ = open_[low[open_] < high[open_]]
        found = np.zeros(n, bool)
        found[open_] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by walking back to a sampled one."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            known = self.sampled[at[open_]]
            hit = open_[known]
            out[hit] = self.samples[self.place[at[hit]]] + steps[hit]
            open_ = open_[~known]
            symbol = self.before[at[open_]]
            at[open_] = self.first[symbol] + self.tree.rank(symbol, at[open_])
            steps[open_] += 1
        return out
