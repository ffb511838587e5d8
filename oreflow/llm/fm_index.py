"""FM-index over word numbers: suffix array, wavelet matrix of the transform, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Ascending order of all suffixes. 0 separates; each 0 counts as smaller than the 0s after it and than all else.

    The text must end with a 0. Suffixes are sorted by as many symbols as fit one number; only those
    that still tie are then sorted by the ranks found so far, doubling the length each time.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    width = min(n, 62 // bits)
    key, open_ = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(width):
        key <<= bits
        here = symbols[k:].astype(np.int64)
        open_[n - k :] = False
        here[~open_[: n - k]] = 0
        key[: n - k] |= here
        open_[: n - k] &= here != 0
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    # A suffix with a separator among its first symbols is told from its equals by its place.
    first = np.append(True, sorted_key[1:] != sorted_key[:-1]) | ~open_[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    reach = width
    slots = np.flatnonzero(~(first & np.append(first[1:], True)))
    while len(slots):
        own = order[slots]
        value = rank[own] * n + rank[own + reach]
        by = np.argsort(value, kind="stable")
        own, value = own[by], value[by]
        order[slots] = own
        first = np.append(True, value[1:] != value[:-1])
        rank[own] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        slots = slots[~(first & np.append(first[1:], True))]
        reach *= 2
    return order


class Bits:
    """A bit row with the number of ones before any place."""

    def __init__(self, flags: np.ndarray):
        n = len(flags)
        raw = np.zeros((n // 64 + 1) * 8, np.uint8)
        packed = np.packbits(flags, bitorder="little")
        raw[: len(packed)] = packed
        self.words = raw.view("<u8")
        counts = np.bitwise_count(self.words)
        self.before = np.cumsum(counts, dtype=np.int64) - counts
        self.ones = int(counts.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def at(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """Rank and access on a row of numbers, one bit row for each bit of a number."""

    def __init__(self, values: np.ndarray, n_symbols: int):
        self.depth = max(1, (n_symbols - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in reversed(range(self.depth)):
            flags = (values >> level) & 1 != 0
            bits = Bits(flags)
            self.levels.append((bits, len(values) - bits.ones))
            values = np.concatenate([values[~flags], values[flags]])
        symbols = np.arange(n_symbols)
        self.first = self._down(symbols, np.zeros(n_symbols, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in enumerate(self.levels):
            ones = bits.rank(at)
            up = (symbols >> (self.depth - 1 - level)) & 1 != 0
            at = np.where(up, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._down(symbols, at) - self.first[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number at each place, and how often it occurs before."""
        symbols = np.zeros(len(at), np.int64)
        for bits, zeros in self.levels:
            ones, up = bits.rank(at), bits.at(at)
            symbols = symbols * 2 + up
            at = np.where(up, zeros + ones, at - ones)
        return symbols, at - self.first[symbols]


class FMIndex:
    """Finds runs of symbols by backward search; 0 separates texts and is never part of a run."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, step: int = 8):
        self.size = len(symbols)
        order = suffix_array(symbols)
        before = symbols[order - 1]  # of place 0, the last separator
        self.tree = WaveletMatrix(before, n_symbols)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        # Sampled: every step-th place, and each place after a separator, so that no walk meets one.
        sampled = (order % step == 0) | (before == 0)
        self.sampled, self.samples = Bits(sampled), order[sampled]

    def ranges(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range of each row of `runs`, which is aligned right and filled up with 0 on the left."""
        low, high = np.zeros(len(runs), np.int64), np.full(len(runs), self.size, np.int64)
        left = np.arange(len(runs))
        for column in reversed(range(runs.shape[1])):
            left = left[(runs[left, column] > 0) & (high[left] > low[left])]
            if not len(left):
                break
            symbols = runs[left, column]
            both = self.tree.rank(np.concatenate([symbols, symbols]), np.concatenate([low[left], high[left]]))
            low[left] = self.smaller[symbols] + both[: len(left)]
            high[left] = self.smaller[symbols] + both[len(left) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the text of each suffix, walked back to the nearest sampled place."""
        places, steps, left = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(left):
            there = self.sampled.at(rows[left])
            done = left[there]
            places[done] = self.samples[self.sampled.rank(rows[done])] + steps
            left = left[~there]
            symbols, before = self.tree.access(rows[left])
            rows[left] = self.smaller[symbols] + before
            steps += 1
        return places
