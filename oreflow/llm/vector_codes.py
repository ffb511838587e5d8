"""Vector codes by active-entry Lloyd: each part of a vector becomes the number of a codebook entry.

Components become whole numbers, so distances, sums and ties are exact at every partitioning. Between
rounds each part keeps its entry and the exact distance to it. A part whose entry did not move in the
last update compares only the entries that moved with the stored distance; every other part is
compared with all entries. An entry wins over another of the same distance by its lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.session import staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Largest whole component; distances of up to 2**10 components then stay under 2**63.
LARGEST = 1 << 26
#: Rows compared with a codebook at a time.
ROWS = 8192
#: So many labels at most are broadcast: all, or those with the most rows.
LABELS = 10_000


@dataclass(frozen=True)
class Codes:
    """`rows` (vec_id, label, code as bytes, error, label_error) and `books` (position, entry, component)."""

    rows: DataFrame
    books: np.ndarray

    def books_sha256(self) -> str:
        """Of all components as decimals, by position, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with finite components only, as whole numbers."""
    for batch in batches:
        lists = batch.column(2).cast(pa.list_(pa.float64()))
        flat = lists.flatten()
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        with np.errstate(invalid="ignore"):
            values = np.floor(flat.fill_null(np.nan).to_numpy(zero_copy_only=False) * SCALE)
            bad = ~(np.abs(values) <= LARGEST)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        wrong = np.concatenate([[0], np.cumsum(bad)])
        keep = lists.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0) & (wrong[ends[1:]] == wrong[ends[:-1]])
        numbers = pa.array(values[np.repeat(keep, sizes)].astype(np.int32))
        kept = pa.array(keep)
        vectors = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes[keep])]), pa.int32()), numbers)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept), vectors], names=["vec_id", "label", "vector"])


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to each entry."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:  # every step is a whole number that a double holds
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        out += (x[:, k].astype(np.int64)[:, None] - entries[:, k]) ** 2
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, the lowest at ties, and the distance to it."""
    far = _distances(x, entries)
    code = far.argmin(axis=1)
    return code, far[np.arange(len(x)), code]


def again(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the result of the round before; `moved` tells which entries have changed since."""
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    active = np.flatnonzero(moved)
    held = np.flatnonzero(~lost)
    if len(active) and len(held):
        near, least = nearest(x[held], entries[active])
        near = active[near]
        better = (least < distance[held]) | ((least == distance[held]) & (near < code[held]))
        code[held[better]], distance[held[better]] = near[better], least[better]
    if lost.any():
        code[lost], distance[lost] = nearest(x[lost], entries)
    return code, distance


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray, moved: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.shape
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            n = batch.num_rows
            x = batch.column(2).flatten().to_numpy().reshape(n, parts, width)
            codes, far = np.empty((n, parts), np.uint8), np.empty((n, parts), np.int64)
            if moved is not None:
                old = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                before = batch.column(4).flatten().to_numpy().reshape(n, parts)
            for p in range(parts):
                if moved is None:
                    codes[:, p], far[:, p] = nearest(x[:, p], books[p])
                else:
                    codes[:, p], far[:, p] = again(x[:, p], books[p], moved[p], old[:, p], before[:, p])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * parts + 1, parts), pa.int32()), pa.array(far.ravel()))
            columns = [*(batch.column(k) for k in range(3)), pa.array([row.tobytes() for row in codes], pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "vector", "code", "distances"])


def _summed(batches: Iterator[pa.RecordBatch], shape: tuple[int, int, int]) -> Iterator[pa.RecordBatch]:
    """Count and component sums of the parts of each entry in this task."""
    parts, entries, width = shape
    counts, sums = np.zeros((parts, entries), np.int64), np.zeros(shape, np.int64)
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, parts, width).astype(np.int64)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], x[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=entries)
    p, e = np.nonzero(counts)
    if len(p):
        place = np.tile(np.arange(width), len(p))
        columns = [np.repeat(p, width), np.repeat(e, width), place, np.repeat(counts[p, e], width), sums[p, e].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["position", "entry", "place", "n", "total"])


_SUMS = "position long, entry long, place long, n long, total long"


def _moved_books(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The entries as the floor of the mean of their parts; those without a part stay."""
    sums = state.select("vector", "code").mapInArrow(partial(_summed, shape=books.shape), _SUMS)
    exact = "decimal(38,0)"
    totals = sums.groupBy("position", "entry", "place").agg(F.sum(F.col("n").cast(exact)).alias("n"), F.sum(F.col("total").cast(exact)).alias("total"))
    out = books.copy()
    for row in totals.collect():  # at most one row for each number of the codebooks
        out[row["position"], row["entry"], row["place"]] = int(row["total"]) // int(row["n"])
    return out


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the error summed over equal labels, however many rows a label has; nulls are one label."""
    summed = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("n"))
    sums = staged(summed.select(F.col("label").alias("own"), F.col("sum").cast("long").alias("label_error"), "n"), "label-errors")
    same = F.col("label").eqNullSafe(F.col("own"))
    columns = ["vec_id", "label", "code", "error", "label_error"]
    labels, rows = sums.agg(F.count("*"), F.sum("n")).first()
    if labels <= LABELS:
        return coded.join(F.broadcast(sums), same).select(columns)
    heavy = F.col("n") > rows / LABELS
    large = F.broadcast(sums.where(heavy))
    rest = coded.join(large, same, "left_anti").join(sums.where(~heavy), same)
    return coded.join(large, same).select(columns).unionByName(rest.select(columns))


def encode_vectors(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> Codes:
    """Codes of all vectors with codebooks of `entries` (at most 256) for each of `parts` equal parts.

    A component x counts as floor(256 * x). The books start as the parts of the vectors with the
    smallest ids (at the same id, the smaller vector; null ids last); with fewer vectors than entries
    there are fewer entries. Left out are rows whose vector is null or empty, holds a null or non-finite
    component or one beyond 2**18, has a length that `parts` does not divide, or another length than
    most (the longer of equally many). Repeated ids and rows are coded each; further columns are
    ignored. An empty table gives no rows and empty books. The driver and the tasks hold the books alone.
    """
    names = [F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding")]
    rows = vectors.select(names)
    fields = [T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("label", rows.schema["label"].dataType)]
    whole = staged(rows.mapInArrow(_whole, T.StructType([*fields, T.StructField("vector", T.ArrayType(T.IntegerType()))])), "whole-vectors")
    lengths = whole.groupBy(F.size("vector").alias("size")).count().where(F.col("size") % parts == 0)
    usual = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    size = usual["size"] if usual else 0
    state = whole.where(F.size("vector") == size)
    first = [row["vector"] for row in state.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()]
    books = np.array(first, np.int64).reshape(len(first), parts, size // parts).transpose(1, 0, 2)
    schema = T.StructType([*whole.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("distances", T.ArrayType(T.LongType()))])
    moved = None
    for _ in range(rounds):
        state = staged(state.mapInArrow(partial(_assigned, books=books, moved=moved), schema), "coded-vectors")
        new = _moved_books(state, books)
        books, moved = new, (new != books).any(axis=2)
    last = state.mapInArrow(partial(_assigned, books=books, moved=moved), schema)
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda total, x: total + x)
    return Codes(_with_label_error(staged(last.select("vec_id", "label", "code", error.alias("error")), "vector-codes")), books)
