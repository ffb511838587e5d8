"""Arrow batches as numpy arrays, and hashes of words over whole batches at once."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import wraps

import numpy as np
import pyarrow as pa

#: ASCII white space, the only separator of plain words.
BLANK = (0x20, *range(0x09, 0x0E))

_RANDOM = np.random.default_rng(0x5EED)
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E6C63D0676A9A99)
_CHUNK = 1 << 21


def lean(work: Callable) -> Callable:
    """A task's work that gives memory it no longer needs back to the machine at its end.

    Python workers live on from task to task; what the allocators keep for them adds up over stages.
    """

    @wraps(work)
    def run(batches, *args, **kwargs):
        try:
            yield from work(batches, *args, **kwargs)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library: it keeps what it keeps

    return run


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the byte offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Splits texts into words by bytes and hashes each word to 64 bits."""

    def __init__(self, separators, fold_case: bool):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        codes = _BYTE_CODES.copy()
        if fold_case:
            codes[0x41:0x5B] = codes[0x61:0x7B]
        codes[~self.is_word] = 0
        self.codes = codes

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end byte of every word; a word never reaches over the end of its text."""
        if not len(data):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        word = self.is_word[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets[offsets < len(data)]] = True
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[1:-1]
        last = word.copy()
        last[:-1] &= ~word[1:] | edge[1:-1]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def hashes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word in order, and for each text the index of its first word (one more entry at the end)."""
        starts, ends = self.spans(data, offsets)
        out = np.empty(len(starts), np.uint64)
        begin = 0
        while begin < len(starts):
            end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + _CHUNK)))
            a, b = starts[begin:end], ends[begin:end]
            lo, hi = int(a[0]), int(b[-1])
            length = np.diff(np.append(a, hi))
            place = np.arange(lo, hi) - np.repeat(a, length)
            powers = np.full(int((b - a).max()) + 1, _BASE)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            values = self.codes[data[lo:hi]]
            values *= powers[np.minimum(place, len(powers) - 1)]
            out[begin:end] = np.add.reduceat(values, a - lo)
            begin = end
        return mix(out), np.searchsorted(starts, offsets)


def rolling(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2**64, of every run of `width` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor, power, span, done = np.uint64(base | 1), words.copy(), 1, 0
    weight = factor  # base ** span
    rest = width
    # Runs of 1, 2, 4, ... words by doubling; those in the binary form of `width` are joined.
    with np.errstate(over="ignore"):
        shift = np.uint64(1)
        while rest:
            if rest & 1:
                out += power[done : done + n] * shift
                shift = shift * weight
                done += span
            rest >>= 1
            if rest:
                power = power[:-span] + power[span:] * weight
                weight = weight * weight
                span *= 2
    return out


def take_ranges(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[start : start + count] of every range, one after the other."""
    total = int(counts.sum())
    if not total:
        return values[:0]
    before = np.cumsum(counts) - counts
    return values[np.repeat(starts - before, counts) + np.arange(total)]


def by_text(firsts: np.ndarray) -> np.ndarray:
    """For each word the row of its text, from the index of each text's first word."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def slices(batch: pa.RecordBatch, column: int, most: int = 16 << 20):
    """The batch in runs of rows with at most about `most` bytes of text each; a longer text comes alone."""
    _, offsets = text_buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end
