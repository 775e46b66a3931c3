"""A run-length index of many short strings.

The Burrows-Wheeler transform of the strings is kept as runs. Suffixes end where
their string ends; equal ones are ordered by string. Streaming strings backwards
through the runs finds each suffix's place; no matching statistics are computed:
the intervals of sorted suffixes that share ``depth`` symbols, and the smallest
owner in each, are taken from the suffix array while it is there.
"""

from __future__ import annotations

import numpy as np

#: Longest string.
WIDTH = 128


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dense ranks, from 1, of pairs of ranks."""
    return np.unique(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64), return_inverse=True)[1] + 1


class RunIndex:
    """Index of strings given as bytes one after another with their lengths, all of UTF-8 text."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, owners: np.ndarray, depth: int):
        if len(lengths) and lengths.max() > WIDTH:
            raise ValueError(f"strings of up to {WIDTH} bytes")
        n, self.depth, self.lengths = len(lengths), depth, lengths
        first = np.cumsum(lengths + 1) - (lengths + 1)  # each string is followed by its empty suffix
        total = int((lengths + 1).sum())
        string = np.repeat(np.arange(n), lengths + 1)
        at = np.arange(total) - first[string]
        left = lengths[string] - at
        symbols = np.zeros(total, np.uint8)
        symbols[left > 0] = data + np.uint8(1)  # 0xFF never occurs in UTF-8, so 0 is free for ends
        # Ranks by 8, 16, 32 and then all symbols; what lies beyond a string's end counts as 0.
        key = np.zeros(total, np.uint64)
        for i in range(8):
            key = key << np.uint64(8) | self._ahead(symbols, left, i).astype(np.uint64)
        rank = np.unique(key, return_inverse=True)[1] + 1
        size, short = 8, None
        while size < WIDTH:
            if size <= depth < 2 * size:
                short = rank, size
            rank = _ranks(rank, self._ahead(rank, left, size))
            size *= 2
        order = np.argsort(rank, kind="stable")  # the suffix array
        before = np.zeros(total, np.uint8)
        before[1:] = symbols[:-1]
        transform = before[order]
        starts = np.flatnonzero(np.concatenate(([True], transform[1:] != transform[:-1])))
        self.run_start, self.run_symbol = starts, transform[starts]
        ends = np.append(starts[1:], total) - 1
        sizes = ends - starts + 1
        # LF of a run's first entry: entries with smaller symbols, then earlier runs of its own.
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        self.run_lf = np.empty(len(starts), np.int64)
        self.run_lf[by_symbol] = np.cumsum(sizes[by_symbol]) - sizes[by_symbol]
        prefix = _ranks(short[0], self._ahead(short[0], left, depth - short[1]))[order]
        deep = left[order] >= depth
        new = np.concatenate(([True], (prefix[1:] != prefix[:-1]) | ~deep[1:] | ~deep[:-1]))
        self.interval_start = np.flatnonzero(new)
        self.interval_owner = np.minimum.reduceat(owners[string][order], self.interval_start) if total else np.zeros(0, np.int64)

    @staticmethod
    def _ahead(values: np.ndarray, left: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(values)
        out[: len(values) - by] = values[by:]
        out[left < by] = 0
        return out

    def step(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol before each entry's suffix and the entry of the suffix longer by it."""
        run = np.searchsorted(self.run_start, at, side="right") - 1
        return self.run_symbol[run], self.run_lf[run] + at - self.run_start[run]

    def owned_before(self, owners: np.ndarray) -> np.ndarray:
        """For each indexed string, bit i is set if its ``depth`` symbols from i also are in a string of a smaller owner."""
        marks = np.zeros(len(self.lengths), np.uint64)
        live, at = np.arange(len(self.lengths)), np.arange(len(self.lengths))  # empty suffixes come first
        for taken in range(1, int(self.lengths.max(initial=0)) + 1):
            going = self.lengths[live] >= taken
            live, (_, at) = live[going], self.step(at[going])
            if taken >= self.depth:
                least = self.interval_owner[np.searchsorted(self.interval_start, at, side="right") - 1]
                hit = least < owners[live]
                marks[live[hit]] |= np.uint64(1) << (self.lengths[live[hit]] - taken).astype(np.uint64)
        return marks
