"""64-bit keys with two small numbers each, sorted and packed for a shuffle.

Millions of (key, document, place) rows cost a shuffle three to four times their content. A task
sorts the rows of a batch instead, cuts them by key range, and sends each cut as one binary value:
differences of sorted keys, and the numbers less their minimum, at the fewest whole bytes.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HEAD = struct.Struct("<IBBBxQqq")

CELLS = T.StructType([T.StructField("part", T.LongType()), T.StructField("payload", T.BinaryType())])


def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return width, values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _widen(raw: bytes, at: int, n: int, width: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    if width:
        wide[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(n, width)
    return wide.view("<u8")[:, 0]


def pack(keys: np.ndarray, docs: np.ndarray, places: np.ndarray) -> bytes:
    """Ascending unsigned keys with a signed 64-bit number and another one each."""
    n = len(keys)
    if not n:
        return _HEAD.pack(0, 0, 0, 0, 0, 0, 0)
    least, first = int(docs.min()), int(places.min())
    steps = np.diff(keys)
    wk, a = _narrow(steps)
    wd, b = _narrow((docs - least).astype(np.uint64))
    wp, c = _narrow((places - first).astype(np.uint64))
    return _HEAD.pack(n, wk, wd, wp, int(keys[0]), least, first) + a + b + c


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, wk, wd, wp, key, least, first = _HEAD.unpack_from(raw)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    at = _HEAD.size
    keys = np.empty(n, np.uint64)
    keys[0] = key
    keys[1:] = _widen(raw, at, n - 1, wk)
    np.cumsum(keys, out=keys)
    at += (n - 1) * wk
    docs = _widen(raw, at, n, wd).astype(np.int64) + least
    return keys, docs, _widen(raw, at + n * wd, n, wp).astype(np.int64) + first


def part_bits(df: DataFrame, text_col: str, per_byte: float, most: int = 500_000) -> int:
    """Bits of a key that name its part, so that a part has about `most` keys: from the bytes of all texts."""
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(4, math.ceil(math.log2(max(1.0, total * per_byte / most))))


def cells(keys: np.ndarray, docs: np.ndarray, places: np.ndarray, bits: int, width: int = 64) -> Iterator[tuple[int, bytes]]:
    """Cuts of rows in ascending order of key, with the number of their part; keys have `width` bits."""
    if not len(keys):
        return
    parts = keys >> np.uint64(width - bits)
    edges = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(keys)], strict=True):
        yield int(parts[a]), pack(keys[a:b], docs[a:b], places[a:b])


def batch_of(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    parts, payloads = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(payloads, pa.binary())], names=["part", "payload"])


def gathered(cut: DataFrame) -> DataFrame:
    """All cuts of a part in one task, next to each other; a task has many parts."""
    return cut.repartition("part").sortWithinPartitions("part")


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Payloads of one part after the other."""
    own, held = None, []
    for batch in batches:
        for part, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part != own and held:
                yield own, held
                held = []
            own = part
            held.append(payload)
    if held:
        yield own, held


def joined(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of all payloads in ascending order of key."""
    keys, docs, places = (np.concatenate(x) for x in zip(*map(unpack, payloads), strict=True))
    order = np.argsort(keys, kind="stable")
    return keys[order], docs[order], places[order]


def group_starts(keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys starts."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)


def group_sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))
