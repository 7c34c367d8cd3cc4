"""A run-length grammar of a string by recompression, and exact extensions between two of its places.

Blocks of one symbol and pairs of two symbols are replaced in turn until nothing is left to replace; equal parts of the string
are cut alike but at their ends. Each round is a level: where its symbols begin in the string, and their numbers, which are
equal just if what they stand for is. To extend a match, two places climb to levels on which both begin a symbol, pass equal
symbols whole, and descend where symbols differ. A block is passed by its length, so it takes one step at any size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

from loomstar.llm.wordbytes import mixed


@dataclass
class Level:
    start: np.ndarray  # where each symbol begins in the string, and the string's end
    symbol: np.ndarray
    in_blocks: bool  # whether the next level has this one's blocks


def _numbered(key: np.ndarray) -> np.ndarray:
    return pd.factorize(key)[0].astype(np.int64)


class Grammar:
    """Levels over ``symbols``. Places of ``stops`` hold a symbol found nowhere else and stay single; one must be first and one last."""

    def __init__(self, symbols: np.ndarray, stops: np.ndarray):
        start, symbol, stop = np.arange(len(symbols) + 1), _numbered(symbols), stops
        self.levels = [Level(start, symbol, True)]
        parts = int(np.count_nonzero(~stop[1:] & stop[:-1])) if len(stop) else 0
        salt = 0
        while len(symbol) - np.count_nonzero(stop) > parts:
            first = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
            if len(first) < len(symbol):
                size = np.diff(np.append(first, len(symbol)))
                symbol = _numbered(symbol[first] * (size.max() + 1) + size)
                start, stop = start[np.append(first, len(start) - 1)], stop[first]
                self.levels.append(Level(start, symbol, False))
            else:
                self.levels[-1].in_blocks = False
            salt += 1
            left = (mixed(symbol.astype(np.uint64) + np.uint64(salt << 40)) & np.uint64(1)).astype(bool)
            pair = np.zeros(len(symbol), bool)
            pair[:-1] = left[:-1] & ~left[1:] & ~stop[:-1] & ~stop[1:]
            if not pair.any():
                continue
            second = np.append(False, pair[:-1])
            key = symbol * (symbol.max() + 2)
            key[:-1] += np.where(pair[:-1], symbol[1:] + 1, 0)
            symbol, stop, start = _numbered(key[~second]), stop[~second], start[np.append(~second, True)]
            self.levels.append(Level(start, symbol, True))

    def _moved(self, k: int, p: np.ndarray, q: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """(whether the next symbols of level ``k`` are equal, by how much both places then move)."""
        level = self.levels[k]
        a, b = (np.searchsorted(level.start, x) - back for x in (p, q))
        equal = level.symbol[a] == level.symbol[b]
        if level.in_blocks and k + 1 < len(self.levels):
            above = self.levels[k + 1].start
            if back:
                left = [x - above[np.searchsorted(above, x) - 1] for x in (p, q)]
            else:
                left = [above[np.searchsorted(above, x, "right")] - x for x in (p, q)]
            return equal, np.minimum(*left)
        return equal, level.start[a + 1] - level.start[a]

    def _begins(self, k: int, p: np.ndarray) -> np.ndarray:
        start = self.levels[k].start
        return start[np.searchsorted(start, p)] == p

    def extend(self, p: np.ndarray, q: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols of the string from ``p`` on equal those from ``q`` on (``back``: those before them); ``p`` and ``q`` differ."""
        p, q, sign, origin = p.copy(), q.copy(), -1 if back else 1, p
        top = len(self.levels) - 1
        left_at: list[np.ndarray] = []
        climbing = np.arange(len(p))
        for k in range(top + 1):
            rising, fallen, here = [], [], climbing
            while len(here):
                if k < top:
                    up = self._begins(k + 1, p[here]) & self._begins(k + 1, q[here])
                    rising.append(here[up])
                    here = here[~up]
                equal, step = self._moved(k, p[here], q[here], back)
                fallen.append(here[~equal])
                here, step = here[equal], sign * step[equal]
                p[here] += step
                q[here] += step
            left_at.append(np.concatenate(fallen) if fallen else climbing[:0])
            climbing = np.concatenate(rising) if rising else climbing[:0]
        down = climbing
        for k in range(top, -1, -1):
            down = here = np.concatenate([down, left_at[k]])
            while len(here):
                equal, step = self._moved(k, p[here], q[here], back)
                here, step = here[equal], sign * step[equal]
                p[here] += step
                q[here] += step
        return np.abs(p - origin)
