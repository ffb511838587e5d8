"""Passages of test items in documents: an FM-index for each shard of documents, searched for every window.

A task takes documents in shards of bounded size, indexes the words of a shard, and searches all
windows of the test items backward through the index. Occurrences are located by sampled suffix
positions; their words merge into removal spans. Words that no item has are one separator in the
index, since no window can reach over them. Words are compared by 64-bit hashes.

The items go to every task in blocks of bounded size. Where there are several blocks, documents with
the spans found so far are written and read again between blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import Words, by_text, lean, slices, text_buffers
from oreflow.llm.fm_index import FMIndex
from oreflow.session import staged

_WORDS = Words([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], fold_case=True)
#: Bytes of text of the items in one block, which is sent to all executors.
BLOCK_BYTES = 4 << 20
#: Bytes of text in one shard.
SHARD_BYTES = 4 << 20


class Windows:
    """All distinct windows of a block of items, as rows of word numbers from 1, with the items of each."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        hashes, firsts = _WORDS.hashes(*text_buffers(pa.array([t for _, t in items], pa.string())))
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        rows, owners = [], []
        for k in range(len(items)):
            own = numbers[firsts[k] : firsts[k + 1]] + 1
            if len(own) >= width:
                found = np.lib.stride_tricks.sliding_window_view(own, width)
            elif len(own):
                found = np.concatenate([np.zeros(width - len(own), own.dtype), own])[None, :]
            else:
                continue
            rows.append(found)
            owners.append(np.full(len(found), k))
        rows, owners = (np.concatenate(rows), np.concatenate(owners)) if rows else (np.empty((0, width), np.int64), np.empty(0, np.int64))
        self.rows, inverse = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([inverse.ravel(), owners]), axis=1)
        self.item_starts = np.searchsorted(pairs[0], np.arange(len(self.rows) + 1))
        self.item_numbers = pairs[1]
        self.item_ids = [i for i, _ in items]
        self.lengths = (self.rows > 0).sum(axis=1)

    def find(self, hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word places and windows of all occurrences in texts whose words are given."""
        none = np.empty(0, np.int64)
        if not len(self.rows) or not len(hashes):
            return none, none
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        numbers = np.where(self.vocabulary[at] == hashes, at + 1, 0)
        # A separator after each text, then one in place of each run of separators.
        ends = firsts[1:]
        symbols = np.insert(numbers, ends, 0)
        places = np.insert(np.arange(len(numbers)), ends, -1)
        keep = np.append(True, (symbols[1:] != 0) | (symbols[:-1] != 0))
        symbols, places = symbols[keep].astype(np.int32), places[keep]
        index = FMIndex(symbols, len(self.vocabulary) + 1)
        low, high = index.ranges(self.rows)
        found = np.flatnonzero((high > low) & (self.lengths > 0))
        counts = high[found] - low[found]
        rows = np.repeat(low[found] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        return places[index.locate(rows)], np.repeat(found, counts)


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Spans joined where they overlap or touch, as rows of start and end."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return np.stack([starts[new], ends[last]], axis=1)


def _hits(texts: pa.Array, windows: Windows, spans: list[list[int] | None]) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Words of each text, and items of those hit; the spans found are merged into `spans`."""
    hashes, firsts = _WORDS.hashes(*text_buffers(texts))
    places, found = windows.find(hashes, firsts)
    own = by_text(firsts)[places] if len(places) else places
    order = np.argsort(own, kind="stable")
    own, places, found = own[order], places[order], found[order]
    edges = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
    items = {}
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(own)], strict=False):
        k = int(own[a])
        starts, old = places[a:b] - firsts[k], np.array(spans[k] or [], np.int64).reshape(-1, 2)
        ends = starts + windows.lengths[found[a:b]]
        spans[k] = merged_spans(np.concatenate([old[:, 0], starts]), np.concatenate([old[:, 1], ends])).ravel().tolist()
        items[k] = {windows.item_ids[i] for w in np.unique(found[a:b]) for i in windows.item_numbers[windows.item_starts[w] : windows.item_starts[w + 1]]} - {None}
    return np.diff(firsts), items


@lean
def _search(batches: Iterator[pa.RecordBatch], block: Broadcast, last: bool) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1, SHARD_BYTES)):
        spans, items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        n_words, hit = _hits(batch.column(1), block.value, spans)
        for k, own in hit.items():
            items[k] = sorted({*items[k], *own})
        text = [] if last else [batch.column(1)]
        columns = [batch.column(0), *text, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *["text"] * (not last), "n_words", "spans", "items"])


def _blocks(items: DataFrame) -> Iterator[list[tuple[str | None, str | None]]]:
    """Items, equal rows once, in blocks of at most BLOCK_BYTES of text; a longer item is a block of its own."""
    items = items.distinct()
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    total = items.agg(F.sum(size)).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES))
    while n > 1:
        number = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
        if items.groupBy(number.alias("block")).agg(F.sum(size).alias("size"), F.count("*").alias("n")).where((F.col("size") > BLOCK_BYTES) & (F.col("n") > 1)).isEmpty():
            break
        n *= 2
    for k in range(n):
        rows = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in rows.collect()]


def find_passages(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, spans (words hit: start and end, start and end, ...) and items (sorted ids, as text) of every document.

    A window is `width` words of an item in a row; an item of fewer words is one window. Null texts
    and texts without words hit nothing, an item without words has no window; without items nothing is
    hit. An item with a null id hits words and isn't listed. Each row of documents stands for itself,
    so repeated rows and null ids give rows alike. Further columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    out = [T.StructField("doc_id", kind), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType()))]
    empty = [F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items")]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *empty)
    listed = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    waiting: Windows | None = None
    for block in _blocks(listed):
        if waiting is not None:
            rows = staged(rows.mapInArrow(partial(_search, block=spark.sparkContext.broadcast(waiting), last=False), T.StructType(out)), "passages").select("doc_id", "text", "spans", "items")
        waiting = Windows(block, width)
    return rows.mapInArrow(partial(_search, block=spark.sparkContext.broadcast(waiting), last=True), T.StructType(out[:1] + out[2:]))


def _without(text: str, own: list[int]) -> str:
    raw = text.encode()
    starts, ends = _WORDS.spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    edges = [0, *(int(x) for a, b in zip(own[::2], own[1::2], strict=True) for x in (starts[a], ends[b - 1])), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()


@lean
def _cut(batches: Iterator[pa.RecordBatch], block: Broadcast, text_at: int, spans_at: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Whole rows with the spans of one more block of items; at the last one the words go, and so do the spans."""
    for batch in (part for whole in batches for part in slices(whole, text_at, SHARD_BYTES)):
        texts, names = batch.column(text_at), batch.schema.names
        spans = batch.column(spans_at).to_pylist() if spans_at < batch.num_columns else [None] * batch.num_rows
        _hits(texts, block.value, spans)
        columns = batch.columns[:spans_at]
        if not last:
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, pa.list_(pa.int32()))], names=[*names[:spans_at], SPANS])
            continue
        if any(spans):
            values = texts.to_pylist()
            for k, own in enumerate(spans):
                if own:
                    values[k] = _without(values[k], own)
            columns[text_at] = pa.array(values, texts.type)
        yield pa.RecordBatch.from_arrays(columns, names=names[:spans_at])


#: Column of the spans found so far, last of the rows that are staged between blocks and gone from the result.
SPANS = "__passage_spans"


def remove_passages(docs: DataFrame, items: DataFrame, width: int = 10, text_col: str = "text") -> DataFrame:
    """The documents, all columns as they were, without the words that items hit; what stands between kept words stays.

    Each row stands for itself, so repeated rows give rows alike; null texts stay null. Texts are read whole.
    Search and removal are one pass of Python workers over whole rows.
    """
    spark, rows = docs.sparkSession, docs
    listed = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    work = partial(_cut, text_at=docs.columns.index(text_col), spans_at=len(docs.columns))
    waiting: Windows | None = None
    for block in _blocks(listed):
        if waiting is not None:
            marked = T.StructType([*docs.schema.fields, T.StructField(SPANS, T.ArrayType(T.IntegerType()))])
            rows = staged(rows.mapInArrow(partial(work, block=spark.sparkContext.broadcast(waiting), last=False), marked), "passages")
        waiting = Windows(block, width)
    return rows.mapInArrow(partial(work, block=spark.sparkContext.broadcast(waiting), last=True), docs.schema)
