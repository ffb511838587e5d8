"""Token-id files: patched frame-of-reference blocks, in Parquet rows that Spark writes and reads.

A shard holds a range of document ids in ascending order. Its rows are segments of whole documents;
`payload` has the ids of all documents of the segment, packed:

    "PFR1", u32 number of ids, u32 number of blocks, u32 first byte of each block, u32 end
    each block of 128 ids: u32 minimum, u8 width, u8 number of exceptions,
        128 * width bits of (id - minimum), low bits first,
        u8 places of the exceptions, u32 values (id - minimum) of the exceptions

The width is the number of bits that the given percentile of a block's values fits in; values that
need more are exceptions. All numbers are little-endian. The last block is padded with its minimum.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import slices, take_ranges

BLOCK = 128
MAGIC = b"PFR1"
#: Percentile of a block's values that fit the packed width.
PERCENTILE = 0.9
#: A segment is closed once it holds so many ids; a longer document is a segment of its own.
SEGMENT_IDS = 1 << 16
#: Stretches remembered by a Python worker; beyond that it forgets all and goes on.
REMEMBERED = 500_000


def pack_ids(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """The ids, unsigned and under 2**32, as one payload."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    head = np.array([n, blocks], "<u4").tobytes()
    if not n:
        return MAGIC + head + np.array([16], "<u4").tobytes()
    table = np.empty(blocks * BLOCK, np.uint32)
    table[:n] = ids
    table[n:] = table[n - n % BLOCK if n % BLOCK else n - BLOCK : n].min()
    table = table.reshape(blocks, BLOCK)
    least = table.min(axis=1)
    table = table - least[:, None]
    bits = np.frexp(table.astype(np.float64))[1].astype(np.uint8)  # 0 for 0
    rank = min(BLOCK - 1, int(BLOCK * percentile))
    width = np.partition(bits, rank, axis=1)[:, rank]
    over = bits > width[:, None]
    exceptions = over.sum(axis=1)
    sizes = 6 + BLOCK // 8 * width.astype(np.int64) + 5 * exceptions
    starts = 12 + 4 * (blocks + 1) + np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(starts[-1]), np.uint8)
    out[:12] = np.frombuffer(MAGIC + head, np.uint8)
    out[12 : starts[0]] = np.frombuffer(starts.astype("<u4").tobytes(), np.uint8)
    at = starts[:-1]
    out[at[:, None] + np.arange(4)] = least.astype("<u4")[:, None].view(np.uint8)
    out[at + 4] = width
    out[at + 5] = exceptions
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            low = np.unpackbits(table[own].astype("<u4").view(np.uint8).reshape(len(own), BLOCK, 4), axis=2, bitorder="little")[:, :, :w]
            packed = np.packbits(low.reshape(len(own), -1), axis=1, bitorder="little")
            out[at[own][:, None] + 6 + np.arange(packed.shape[1])] = packed
    rows, places = np.nonzero(over)
    if len(rows):
        rank = np.arange(len(rows)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        first = at[rows] + 6 + BLOCK // 8 * width[rows].astype(np.int64)
        out[first + rank] = places
        out[(first + exceptions[rows] + 4 * rank)[:, None] + np.arange(4)] = table[rows, places].astype("<u4")[:, None].view(np.uint8)
    return out.tobytes()


def unpack_ids(payload: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
    """Ids first .. first + count of a payload; only the blocks that hold them are read."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block payload")
    raw = np.frombuffer(payload, np.uint8)
    n, blocks = np.frombuffer(payload, "<u4", 2, 4).astype(np.int64)
    count = n - first if count is None else min(count, n - first)
    if count <= 0:
        return np.empty(0, np.uint32)
    b0, b1 = first // BLOCK, -(-(first + count) // BLOCK)
    at = np.frombuffer(payload, "<u4", blocks + 1, 12).astype(np.int64)[b0:b1]
    least = raw[at[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
    width, exceptions = raw[at + 4], raw[at + 5].astype(np.int64)
    table = np.zeros((len(at), BLOCK), np.uint32)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            packed = np.zeros((len(own), BLOCK // 8 * int(w) + 5), np.uint64)
            packed[:, :-5] = raw[at[own][:, None] + 6 + np.arange(BLOCK // 8 * int(w))]
            bit = np.arange(BLOCK) * int(w)
            # A value lies in at most five bytes.
            joint = packed[:, bit >> 3]
            for k in range(1, (int(w) + 14) // 8):
                joint |= packed[:, (bit >> 3) + k] << np.uint64(8 * k)
            table[own] = joint >> (bit & 7).astype(np.uint64) & np.uint64((1 << int(w)) - 1)
    if exceptions.any():
        rows = np.repeat(np.arange(len(at)), exceptions)
        rank = np.arange(len(rows)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        start = at[rows] + 6 + BLOCK // 8 * width[rows].astype(np.int64)
        places = raw[start + rank]
        table[rows, places] = raw[(start + exceptions[rows] + 4 * rank)[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
    flat = (table + least[:, None]).ravel()
    return flat[first - b0 * BLOCK : first - b0 * BLOCK + count]


class CachedTokenizer:
    """A byte-level tokenizer of the tokenizers library that encodes each distinct stretch of text once.

    A text is cut before each space that a character other than white space follows: there the
    pre-tokenizer always starts anew, so the ids of a text are those of its stretches joined.
    """

    _ODD = " [\\t-\\r \\x1c-\\x1f\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]|^ "

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        # Stretches of these characters fall into units that the pre-tokenizer finds too, so the
        # library's model alone can take them; it wants bytes by their printable stand-ins.
        self.simple = re.compile(" ?[.,;:!?A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?\\nA-Za-zÀ-ÖØ-öø-ÿ]*")
        self.units = re.compile("\\n| ?[.,;:!?]+| ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}
        self.cut = regex.compile(r" (?=[^\s\x1c-\x1f])")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids start (one more entry at the end)."""
        texts = texts.fill_null("").cast(pa.string())
        odd = np.flatnonzero(pc.match_substring_regex(texts, self._ODD).to_numpy(zero_copy_only=False))
        lists = pc.split_pattern(texts, " ").cast(pa.list_(pa.string()))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)])
        flat, parts, done = lists.flatten(), [], 0
        for k in odd.tolist():
            own = self.cut.split(texts[k].as_py())
            parts += [flat.slice(ends[done], ends[k] - ends[done]), pa.array(own, pa.string())]
            counts[k], done = len(own), k + 1
        words = pa.concat_arrays([*parts, flat.slice(ends[done])]) if parts else flat
        firsts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        leads = np.zeros(len(words), bool)
        leads[firsts[:-1]] = True
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        spaced = coded.dictionary.to_pylist()
        lead_index = np.unique(index[leads])
        each = self._ids([" " + w for w in spaced] + [spaced[i] for i in lead_index.tolist()])
        place = np.zeros(len(spaced), np.int64)
        place[lead_index] = len(spaced) + np.arange(len(lead_index))
        index = np.where(leads, place[index], index)
        sizes = np.fromiter(map(len, each), np.int64, len(each)) >> 2
        ids = np.frombuffer(b"".join(each), "<u4")
        out = take_ranges(ids, (np.cumsum(sizes) - sizes)[index], sizes[index])
        return out, np.concatenate([[0], np.cumsum(sizes[index])]).astype(np.int64)[firsts]

    def _ids(self, stretches: list[str]) -> list[bytes]:
        """Ids of each stretch as bytes; those not seen before go to the library together."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        found = list(map(known.get, stretches))
        new = [k for k, x in enumerate(found) if x is None]
        rest = []
        for k in new:
            s = stretches[k]
            if s.isascii() and (s[1:] if s[:1] == " " else s).isalpha():
                x = known.get(s)
                found[k] = self._unit(s) if x is None else x
            elif self.simple.fullmatch(s) and "\n\n" not in s:
                found[k] = b"".join([known.get(u) or self._unit(u) for u in self.units.findall(s)])
            else:
                rest.append(k)
        texts = list(dict.fromkeys(stretches[k] for k in rest))
        for s, x in zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            known[s] = array("I", x.ids).tobytes()
        for k in rest:
            found[k] = known[stretches[k]]
        return found

    def _unit(self, unit: str) -> bytes:
        coded = "Ġ" + unit[1:] if unit[0] == " " and unit.isascii() and len(unit) > 1 and unit[1:].isalpha() else "".join(map(self.alphabet.__getitem__, unit.encode()))
        out = self.known[unit] = array("I", [t.id for t in self.tokenizer.model.tokenize(coded)]).tobytes()
        return out


@lru_cache(maxsize=2)
def tokenizer_at(path: str) -> CachedTokenizer:
    return CachedTokenizer(path)


def _write(batches: Iterator[pa.RecordBatch], path: str, end_id: int, segment_ids: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    tokenizer, shard = tokenizer_at(path), TaskContext.get().partitionId()
    segment, before, waiting, held = 0, 0, 0, []
    docs: list = []
    lengths: list[int] = []

    def close() -> pa.RecordBatch:
        nonlocal segment, before, held, docs, lengths
        ids = np.concatenate(held)
        row = pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([docs], pa.list_(id_type)), pa.array([lengths], pa.list_(pa.int64())), pa.array([pack_ids(ids)], pa.binary()),
            ],
            names=SEGMENT_NAMES,
        )
        segment, before, held, docs, lengths = segment + 1, before + len(ids), [], [], []
        return row

    end = np.array([end_id], np.uint32)
    for whole in batches:
        for batch in slices(whole, 1, 12 << 20):
            ids, starts = tokenizer.encode(batch.column(1))
            for k, doc in enumerate(batch.column(0).to_pylist()):
                held += [ids[starts[k] : starts[k + 1]], end]
                docs.append(doc)
                lengths.append(int(starts[k + 1] - starts[k]) + 1)
                waiting += lengths[-1]
                if waiting >= segment_ids:
                    yield close()
                    waiting = 0
    if docs:
        yield close()


SEGMENT_NAMES = ["shard", "segment", "shard_start", "n_ids", "doc_ids", "lengths", "payload"]


def _read(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            docs, own, payload, start = (batch.column(c)[k] for c in range(4))
            ids = unpack_ids(payload.as_py()).astype("<u4")
            lengths = own.values.to_numpy()
            ends = np.cumsum(lengths)
            # The ids stay one buffer, which the documents' offsets cut.
            offsets = np.concatenate([[0], 4 * ends]).astype(np.int64)
            values = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
            columns = [docs.values.cast(id_type), pa.array(start.as_py() + ends - lengths), pa.array(lengths), values.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_le"])


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", segment_ids: int = SEGMENT_IDS) -> None:
    """Tokenizes every whole text, appends `end_id`, and writes the ids in ascending order of document id.

    Documents are dealt by ranges of their id, nulls first; equal ids are ordered by text. A null or
    empty text gives the end id alone. An empty table gives an empty folder that can be read.
    The text is shuffled, not the ids, which would take more room.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField(n, t) for n, t in zip(SEGMENT_NAMES, [T.IntegerType(), T.IntegerType(), T.LongType(), T.LongType(), T.ArrayType(kind), T.ArrayType(T.LongType()), T.BinaryType()], strict=True)]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(partial(_write, path=tokenizer_path, end_id=end_id, segment_ids=segment_ids, id_type=to_arrow_type(kind)), schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_le (ids as little-endian unsigned 32-bit numbers) from the files."""
    from pyspark.sql.pandas.types import to_arrow_type

    segments = spark.read.parquet(path)
    kind = segments.schema["doc_ids"].dataType.elementType
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("own"))
    # One row for each shard, that is for each partition of the writer.
    before = totals.select("shard", (F.sum("own").over(Window.orderBy("shard")) - F.col("own")).alias("before"))
    rows = segments.join(F.broadcast(before), "shard").select("doc_ids", "lengths", "payload", (F.col("before") + F.col("shard_start")).alias("start"))
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_le", T.BinaryType())])
    return rows.mapInArrow(partial(_read, id_type=to_arrow_type(kind)), schema)
