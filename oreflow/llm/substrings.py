"""Removal of passages that a document with a smaller id has too.

Rabin-Karp hashes of every window of words are sorted and packed per batch, shuffled by ranges of
the hash, and compared where all documents' hashes of a range meet. Windows that are also in a
smaller document come back as places by document and merge into removal intervals.

Two different windows share a 64-bit hash by chance alone: at n windows about n * n / 2**65 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import BLANK, Words, mix, rolling, slices, take_ranges, text_buffers
from oreflow.llm.packed import CELLS, batch_of, cells, gathered, group_sizes, group_starts, joined, pack, part_bits, parts_of, unpack

_BASE = 0xA24BAED4963EE407
_WORDS = Words(BLANK, fold_case=False)
#: Places that a task holds back to send them together.
HELD = 2_000_000


def _windows(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1, 8 << 20)):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        hashes, firsts = _WORDS.hashes(*text_buffers(batch.column(1)))
        counts = np.maximum(np.diff(firsts) - width + 1, 0)
        keys = mix(take_ranges(rolling(hashes, width, _BASE), firsts[:-1], counts))
        places = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
        order = np.argsort(keys, kind="stable")
        keys, docs, places = keys[order], np.repeat(ids, counts)[order], places[order]
        starts = group_starts(keys)
        least = np.minimum.reduceat(docs, starts) if len(keys) else docs
        # A smaller document in the same batch decides at once, so a frequent window is sent once a batch.
        here = docs > np.repeat(least, group_sizes(starts, len(keys)))
        rows = list(cells(keys[~here], docs[~here], places[~here], bits))
        if here.any():
            rows.append((-1 - int(keys[0] >> np.uint64(32)), pack(np.zeros(int(here.sum()), np.uint64), docs[here], places[here])))
        yield batch_of(rows)


def _repeated(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Documents and places of windows that a smaller document has, packed by a hash of the document."""
    held, size = [], 0

    def sent() -> pa.RecordBatch:
        docs, places = (np.concatenate(x) for x in zip(*held, strict=True))
        parts = mix(docs.astype(np.uint64)) >> np.uint64(64 - bits)
        order = np.lexsort((places, docs, parts))
        docs, places, parts = docs[order], places[order], parts[order]
        starts = group_starts(parts)
        ends = np.append(starts[1:], len(parts))
        return batch_of([(int(parts[a]), pack(np.zeros(b - a, np.uint64), docs[a:b], places[a:b])) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])

    for part, payloads in parts_of(batches):
        if part < 0:
            found = [unpack(x)[1:] for x in payloads]
        else:
            keys, docs, places = joined(payloads)
            starts = group_starts(keys)
            later = docs > np.repeat(np.minimum.reduceat(docs, starts), group_sizes(starts, len(keys))) if len(keys) else np.zeros(0, bool)
            found = [(docs[later], places[later])]
        held += [x for x in found if len(x[0])]
        size = sum(len(x[0]) for x in held)
        if size > HELD:
            yield sent()
            held = []
    if held:
        yield sent()


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, payloads in parts_of(batches):
        docs, places = (np.concatenate(x) for x in zip(*(unpack(x)[1:] for x in payloads), strict=True))
        order = np.lexsort((places, docs))
        docs, places = docs[order], places[order]
        starts = group_starts(docs)
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(docs)), pa.int32()), pa.array(places, pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(docs[starts], pa.int64()), lists], names=["doc_id", "places"])


def repeated_windows(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and places (array of int) of the windows of `width` words that also start in a smaller document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    bits = part_bits(rows, "text", 1 / 6)
    cut = rows.mapInArrow(partial(_windows, width=width, bits=bits), CELLS)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("places", T.ArrayType(T.IntegerType()))])
    by_document = gathered(cut).mapInArrow(partial(_repeated, bits=max(4, bits - 3)), CELLS)
    return gathered(by_document).mapInArrow(_by_document, schema)


def _kept(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1, 4 << 20)):
        n_words, n_removed, kept = [], [], []
        for text, places in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            words = (text or "").encode().split()  # of bytes: at ASCII white space
            n_words.append(len(words))
            if places.is_valid and len(places):
                cover = np.zeros(len(words) + width + 1, np.int64)
                at = np.unique(places.values.to_numpy(zero_copy_only=False))
                cover[at] += 1
                cover[at + width] -= 1
                stay = np.flatnonzero(np.cumsum(cover)[: len(words)] == 0).tolist()
                words = [words[i] for i in stay]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space) of every document.

    A word goes if a window of `width` words over it also starts in a document with a smaller id;
    windows are judged on the input. Ids must be whole numbers. A null text has no words. A document
    with a null id keeps all its words and takes none from others. Rows that share an id count as one
    document: they take nothing from each other, and places found in one are taken from all of them.
    """
    found = repeated_windows(docs, width, id_col, text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return base.join(found, "doc_id", "left").select("doc_id", "text", "places").mapInArrow(partial(_kept, width=width), schema)
