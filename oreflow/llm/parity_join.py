"""Documents whose sets of word shingles are alike, by parity sketches.

A document's shingles fall into buckets by hash; the XOR of a bucket's hashes is its part of the
document's sketch. Every shingle that only one of two documents has flips one bucket at most, so the
buckets that differ are no more than the symmetric difference. Sizes come in bands; at 75 % overlap
the difference within a band and the next is at most a third of the band's largest size, and with more
buckets than that some must agree (pigeonhole). Documents meet where they share the sketch of a
bucket, and their whole sets are then compared.

Nothing is lost to empty, frequent or very many buckets:

* A document with so few filled buckets that all agreeing ones may be empty also meets others by the
  first quarter of its shingles in order of hash (the prefix that any document alike must touch).
* Two documents that share fewer keys than must agree are no candidates.
* In a group of at most GROUP documents all pairs are candidates. In a larger one each document meets
  the smallest. More is needed only for documents so full of frequent buckets that no other may be left
  to agree. Of these, those that share one of their rarest frequent keys are compared by a short sketch of
  the whole document, a large group in blocks, and only pairs in different components that are near leave a task.
* Pairs that links have already joined are not compared.

Equal sets are one class from the start. Shingles are 64-bit hashes; sets are compared by 40 bits of
each, of which two in a pair of documents of 500 shingles are mistaken once in four million pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import BLANK, Words, lean, mix, rolling, slices, take_ranges, text_buffers
from oreflow.llm.components import components
from oreflow.llm.packed import CELLS, batch_of, cells, gathered, group_sizes, group_starts, joined, part_bits, parts_of
from oreflow.session import staged

_BASE = 0xD6E8FEB86659FD93
_WORDS = Words(BLANK, fold_case=True)
SHINGLE = 5
#: Largest group in which all pairs are candidates.
GROUP = 16
#: Requests for sets that are sent to all executors instead of shuffling the texts (about 40 bytes each).
SMALL_REQUESTS = 1_000_000
#: Whole-document sketches have 2 ** so many bits: of pairs before their sets are compared, and within large groups.
SKETCH_BITS, BRIEF_BITS = 12, 11
#: Documents compared with one copy of a set; a set that more ask for is sent several times.
FAN = 512
#: Documents of a large group that one task compares, by sketches, with those of another block.
BLOCK = 4096
#: Rows that a task holds back to send them once.
FLUSH = 400_000
_SLICE = 3 << 20


def _bands(most: int = 1 << 33) -> np.ndarray:
    """Smallest size of each band; a band ends below four thirds of it, plus one."""
    out = [1]
    while out[-1] < most:
        out.append(out[-1] * 4 // 3 + 1)
    return np.array(out, np.int64)


BANDS = _bands()


def differences(level: np.ndarray) -> np.ndarray:
    """Most shingles that only one of two documents has, of which the smaller is in the band."""
    return (BANDS[level + 1] - 1) // 3


def buckets(level: np.ndarray) -> np.ndarray:
    d = differences(level)
    return d + d // 3 + 3


class Sets:
    """The distinct shingles of a batch: hashes ascending within each document."""

    def __init__(self, column: pa.Array):
        hashes, firsts = _WORDS.hashes(*text_buffers(column))
        lengths = np.diff(firsts)
        counts = np.maximum(lengths - SHINGLE + 1, 0)
        shingles = take_ranges(mix(rolling(hashes, SHINGLE, _BASE)), firsts[:-1], counts)
        rows = np.repeat(np.arange(len(lengths)), counts)
        for k in np.flatnonzero((lengths > 0) & (lengths < SHINGLE)).tolist():
            own = rolling(hashes[firsts[k] : firsts[k + 1]], int(lengths[k]), _BASE + 2 * int(lengths[k]))
            shingles, rows = np.append(shingles, mix(own)), np.append(rows, k)
        order = np.lexsort((shingles, rows))
        shingles, rows = shingles[order], rows[order]
        new = np.append(True, (shingles[1:] != shingles[:-1]) | (rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, bool)
        self.hashes, self.rows = shingles[new], rows[new]
        self.sizes = np.bincount(self.rows, minlength=len(lengths)).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def prints(self) -> np.ndarray:
        """A number for each set, the same for equal sets."""
        out = np.zeros(len(self.sizes), np.uint64)
        if len(self.rows):
            some = self.sizes > 0
            out[some] = mix(np.add.reduceat(mix(self.hashes), self.starts[some]) + self.sizes[some].astype(np.uint64))
        return out

    def sketches(self, lower: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the filled buckets at the own level (lower 0) or the one below (1), their rows; by row, the filled buckets and those to spare.

        To spare are filled buckets beyond the most that may differ from any document alike that is met at
        this level: a seventh of both sizes together.
        """
        level = np.searchsorted(BANDS, self.sizes, side="right") - 1 - lower
        valid = (self.sizes > 0) & (level >= 0)
        level = np.where(valid, level, 0)
        k = np.where(valid, buckets(level), 0)
        on = valid[self.rows]
        hashes, rows = self.hashes[on], self.rows[on]
        bucket = ((hashes >> np.uint64(32)) * k[rows].astype(np.uint64)) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (rows[1:] != rows[:-1]))) if len(rows) else np.empty(0, np.int64)
        rows = rows[starts]
        parity = np.bitwise_xor.reduceat(hashes, starts) if len(starts) else hashes
        where = mix((level[rows].astype(np.uint64) << np.uint64(40)) + bucket[starts])
        keys = mix(parity ^ where)
        # The last bit tells even from odd levels, so that frequent buckets can be counted for each.
        keys = (keys & ~np.uint64(1)) | (level[rows] & 1).astype(np.uint64)
        filled = np.bincount(rows, minlength=len(k))
        other = np.minimum(self.sizes, BANDS[level + 1] - 1) if lower else self.sizes * 4 // 3
        spare = filled - (self.sizes + other) // 7
        return keys, rows, np.where(valid, filled, 0), np.where(valid, spare, 1 << 30)

    def whole_sketch(self, row: int, bits: int) -> bytes:
        own = self.hashes[self.starts[row] : self.starts[row] + self.sizes[row]]
        odd = np.bincount((own >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes()

    def prefixes(self, weak: np.ndarray, lower: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the first shingles of documents weak at a level, as in sketches, and their rows; the last bit is that of the level."""
        counts = np.where(weak, self.sizes - (3 * self.sizes + 3) // 4 + 1, 0)
        keys = mix(take_ranges(self.hashes, self.starts, counts) ^ np.uint64(0x5851F42D4C957F2D))
        rows = np.repeat(np.arange(len(counts)), counts)
        level = np.searchsorted(BANDS, self.sizes, side="right") - 1 - lower
        return (keys & ~np.uint64(1)) | (level[rows] & 1).astype(np.uint64), rows


STATS = ["doc_id", "n_shingles", "print", "band", "filled_even", "filled_odd", "spare_even", "spare_odd", "sketch"]


@lean
def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1, _SLICE)):
        sets = Sets(batch.column(1))
        level = np.searchsorted(BANDS, sets.sizes, side="right") - 1
        own, below = sets.sketches(0)[2:], sets.sketches(1)[2:]
        numbers = [np.where(level & 1 == parity, own[k], below[k]).astype(np.int64) for k in (0, 1) for parity in (0, 1)]
        columns = [batch.column(0), pa.array(sets.sizes), pa.array(sets.prints().view(np.int64)), pa.array(level), *map(pa.array, numbers)]
        columns.append(pa.array([sets.whole_sketch(k, BRIEF_BITS) for k in range(batch.num_rows)], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=STATS)


@lean
def _sketches(batches: Iterator[pa.RecordBatch], bits: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1, _SLICE)):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        sets = Sets(batch.column(1))
        # Of copies in a batch one stands for all; stats join the others to it.
        order = np.lexsort((ids, sets.prints()))
        prints = sets.prints()[order]
        leads = np.zeros(len(ids), bool)
        leads[order[group_starts(prints)]] = True
        own, own_rows, _, spare = sets.sketches(0)
        below, below_rows, _, spare_below = sets.sketches(1)
        prefix, prefix_rows = sets.prefixes(spare <= 0, 0)
        lower, lower_rows = sets.prefixes(spare_below <= 0, 1)
        keys, rows = np.concatenate([own, below, prefix, lower]), np.concatenate([own_rows, below_rows, prefix_rows, lower_rows])
        keys, rows = keys[leads[rows]], rows[leads[rows]]
        keys = ((keys >> np.uint64(64 - width)) & ~np.uint64(1)) | (keys & np.uint64(1))
        order = np.argsort(keys, kind="stable")
        yield batch_of(list(cells(keys[order], ids[rows[order]], np.zeros(len(order), np.int64), bits, width)))


def _tally(pairs: list[np.ndarray]) -> np.ndarray:
    """Distinct pairs from rows (a, b, parity), with the number of rows of even and of odd parity."""
    if not pairs:
        return np.empty((0, 4), np.int64)
    rows = np.concatenate(pairs)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    starts = np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))) if len(rows) else np.empty(0, np.int64)
    odd = np.add.reduceat(rows[:, 2], starts) if len(rows) else rows[:, 2]
    return np.column_stack([rows[starts, :2], group_sizes(starts, len(rows)) - odd, odd])


@lean
def _meet(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b) of small groups and of the smallest of large ones, with the keys they share; members (key, b, size) of large groups with kind 1."""
    pairs: list[np.ndarray] = []
    members: list[np.ndarray] = []

    def sent() -> pa.RecordBatch:
        two = _tally(pairs)
        hot = np.concatenate(members) if members else np.empty((0, 4), np.int64)
        both = np.concatenate([two, hot])
        kinds = np.repeat(np.array([0, 1], np.int32), [len(two), len(hot)])
        return pa.RecordBatch.from_arrays([pa.array(kinds), *(pa.array(both[:, k]) for k in range(4))], names=["kind", "a", "b", "even", "odd"])

    for _, payloads in parts_of(batches):
        keys, docs, _ = joined(payloads)
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        fresh = np.append(True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])) if len(keys) else np.zeros(0, bool)
        keys, docs = keys[fresh], docs[fresh]
        starts = group_starts(keys)
        sizes = group_sizes(starts, len(keys))
        own, parity = np.repeat(sizes, sizes), (keys & np.uint64(1)).astype(np.int64)
        for gap in range(1, group):
            at = np.flatnonzero((own > gap) & (own <= group))
            at = at[(at + gap < len(keys))]
            at = at[keys[at] == keys[at + gap]]
            if not len(at):
                break
            pairs.append(np.column_stack([docs[at], docs[at + gap], parity[at]]))
        large = np.flatnonzero(own > group)
        if len(large):
            first = np.repeat(docs[starts], sizes)[large]
            apart = first != docs[large]
            pairs.append(np.column_stack([first, docs[large], parity[large]])[apart])
            members.append(np.column_stack([keys[large].astype(np.int64), docs[large], own[large], np.zeros(len(large), np.int64)]))
        if sum(map(len, pairs)) + sum(map(len, members)) > FLUSH:
            yield sent()
            pairs, members = [], []
    yield sent()


@lean
def _near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one unit (key, i, j) in different components whose sizes and sketches are near."""

    def pairs(rows: list[tuple]) -> np.ndarray:
        nodes, parts, bands, sizes = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 6, 7))
        bits = np.stack([np.frombuffer(r[8] or bytes(1 << BRIEF_BITS >> 3), "<u8") for r in rows])
        blank = np.array([r[8] is None for r in rows])
        values, counts = np.unique(parts, return_counts=True)
        minor = np.flatnonzero(parts != values[counts.argmax()])
        place = np.full(len(rows), len(rows))  # of two minor ones the first finds the pair
        place[minor] = np.arange(len(minor))
        found = []
        for turn, k in enumerate(minor.tolist()):
            fit = (place > turn) & (parts != parts[k]) & (np.minimum(bands, bands[k]) % 2 == rows[k][5])
            at = np.flatnonzero(fit & (4 * np.minimum(sizes, sizes[k]) >= 3 * np.maximum(sizes, sizes[k])))
            differ = np.bitwise_count(bits[at] ^ bits[k]).sum(axis=1, dtype=np.int64)
            at = at[blank[at] | blank[k] | (differ <= (sizes[at] + sizes[k]) // 7)]
            found.append(np.column_stack([np.minimum(nodes[at], nodes[k]), np.maximum(nodes[at], nodes[k])]))
        return np.concatenate(found) if found else np.empty((0, 2), np.int64)

    def sent() -> pa.RecordBatch:
        two = np.unique(np.concatenate(held), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1])], names=["a", "b"])

    unit, rows, held = None, [], []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:3] != unit and rows:
                held.append(pairs(rows))
                rows = []
                if sum(map(len, held)) > FLUSH:
                    yield sent()
                    held = []
            unit = row[:3]
            rows.append(row)
    if rows:
        held.append(pairs(rows))
    if held:
        yield sent()


@lean
def _asked(batches: Iterator[pa.RecordBatch], sketch: bool) -> Iterator[pa.RecordBatch]:
    """Sends the set of each document, or its size and parity sketch, to all that asked: (owner, copy, member, doc_id, 5 bytes a hash)."""
    for batch in (part for whole in batches for part in slices(whole, 1, 2 << 20)):
        ids = batch.column(0).to_pylist()
        sets = Sets(batch.column(1))
        raw = (sets.hashes >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
        rows = []
        for k, asked in enumerate(batch.column(2).to_pylist()):
            a, n = int(sets.starts[k]), int(sets.sizes[k])
            own = raw[5 * a : 5 * (a + n)]
            if sketch:
                own = n.to_bytes(8, "little") + sets.whole_sketch(k, SKETCH_BITS)
            rows += [(x["owner"], x["copy"], ids[k] != x["owner"], ids[k], own) for x in asked]
        names = ["owner", "copy", "member", "doc_id", "hashes"]
        kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
        for at in range(0, len(rows), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[at : at + 4096], strict=True), kinds, strict=True)], names=names)


@lean
def _compare(batches: Iterator[pa.RecordBatch], sketch: bool) -> Iterator[pa.RecordBatch]:
    """Links between an owner, whose set comes first, and the members that follow it; by sketches, those that can be links."""

    def near(a: np.ndarray, b: np.ndarray) -> bool:
        # Places where the sketches differ are no more than shingles that only one has: at most a seventh of all.
        return int(np.bitwise_count(a[1:] ^ b[1:]).sum()) <= int(a[0] + b[0]) // 7

    def alike(a: np.ndarray, b: np.ndarray) -> bool:
        if 4 * len(a) < 3 * len(b) or 4 * len(b) < 3 * len(a) or not len(a):
            return False
        both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
        return both > 0 and 100 * both >= 75 * (len(a) + len(b) - both)

    def numbers(raw: bytes) -> np.ndarray:
        wide = np.zeros((len(raw) // 5, 8), np.uint8)
        wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
        return wide.view("<u8")[:, 0]

    at, sets = None, []
    for batch in batches:
        a, b = [], []
        for k in range(batch.num_rows):
            owner, copy, member = (batch.column(i)[k].as_py() for i in range(3))
            value = batch.column(4)[k].as_py()
            own = np.frombuffer(value, "<u8") if sketch else numbers(value)
            if (owner, copy) != at:
                at, sets = (owner, copy), []
            if not member:
                sets.append(own)
                continue
            if any(near(first, own) if sketch else alike(first, own) for first in sets):
                a.append(owner)
                b.append(batch.column(3)[k].as_py())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


_MET = T.StructType([T.StructField("kind", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in ("a", "b", "even", "odd")]])
_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _once(placed: DataFrame) -> DataFrame:
    """key and n of the groups to compare: not yet of one component, and one of those with the same nodes and parity.

    A pair is compared only in a group of the parity of its smaller band, so each parity needs its own.
    """
    open_ = placed.groupBy("key", "parity").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum")).where("low <> high")
    return open_.groupBy("n", "sum", "parity").agg(F.min("key").alias("key")).select("key", "n")


def verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are alike, among those whose sketches allow it. `texts` has doc_id and text."""
    return _compared(texts, staged(_compared(texts, pairs, True).distinct(), "near"), False)


def _compared(texts: DataFrame, pairs: DataFrame, sketch: bool) -> DataFrame:
    copies = pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN).cast("int").alias("copies"))
    members = pairs.join(copies, "a").select(F.col("b").alias("doc_id"), F.struct(F.col("a").alias("owner"), F.pmod(F.xxhash64("b"), "copies").cast("int").alias("copy")).alias("asked"))
    owners = copies.select(F.col("a").alias("doc_id"), F.explode(F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda x: F.struct(F.col("a").alias("owner"), x.cast("int").alias("copy")))).alias("asked"))
    requests = staged(owners.unionByName(members).groupBy("doc_id").agg(F.collect_list("asked").alias("asked")), "requests")
    few = requests.select(F.size("asked").alias("n")).agg(F.sum("n")).first()[0] or 0
    rows = texts.join(F.broadcast(requests) if few <= SMALL_REQUESTS else requests, "doc_id").select("doc_id", "text", "asked")
    schema = T.StructType([T.StructField("owner", T.LongType()), T.StructField("copy", T.IntegerType()), T.StructField("member", T.BooleanType()), T.StructField("doc_id", T.LongType()), T.StructField("hashes", T.BinaryType())])
    sent = rows.mapInArrow(partial(_asked, sketch=sketch), schema).repartition("owner", "copy").sortWithinPartitions("owner", "copy", "member")
    return sent.mapInArrow(partial(_compare, sketch=sketch), _LINKS)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles and component_id of every document; components join documents alike to 75 % (intersection over union).

    Ids must be whole numbers. Null and empty texts and texts without words have no shingles and stand
    alone. `group` decides how candidates are found, not which links there are. A document with a null id has a null component. Rows that share an id are one document, which
    is like another if one of its texts is. Further columns are ignored. An empty table gives no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = base.where("doc_id IS NOT NULL AND text IS NOT NULL")
    kinds = [T.StructField(n, T.BinaryType() if n == "sketch" else T.LongType()) for n in STATS]
    stats = staged(base.mapInArrow(_stats, T.StructType(kinds)), "shingle-stats")
    some = stats.where("n_shingles > 0 AND doc_id IS NOT NULL")
    heads = some.groupBy("print", "n_shingles").agg(F.min("doc_id").alias("head"))
    # One row for each document: its class, and what can be said about it without its text.
    classes = staged(some.join(heads, ["print", "n_shingles"]).groupBy("doc_id").agg(F.min("head").alias("head"), F.max("n_shingles").alias("largest"), F.min("n_shingles").alias("smallest"), F.max("band").alias("band"), *[F.min(c).alias(c) for c in STATS[4:-1]], F.when(F.min("print") == F.max("print"), F.min("sketch")).alias("sketch")), "classes")
    bits = part_bits(texts, "text", 1 / 6)
    width = min(62, max(40, bits + math.ceil(math.log2(500_000)) + 18))
    met = staged(gathered(texts.mapInArrow(partial(_sketches, bits=bits, width=width), CELLS)).mapInArrow(partial(_meet, group=group), _MET), "met")

    hot = met.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("doc_id"), F.col("even").alias("often"))
    frequent = hot.groupBy("doc_id").agg(F.sum(1 - F.col("key").bitwiseAND(1)).alias("even"), F.sum(F.col("key").bitwiseAND(1)).alias("odd"))
    known = staged(classes.drop("sketch").join(frequent, "doc_id", "left").fillna(0, ["even", "odd"]), "known")

    def side(name: str) -> DataFrame:
        return known.select(*[F.col(c).alias(name if c == "doc_id" else f"{name}_{c}") for c in known.columns])

    def heads_of(pairs: DataFrame, counted: bool) -> DataFrame:
        """Pairs of class heads, smaller first, that can be alike by their sizes and, if counted, by the keys they share.

        Of the filled buckets of either, all but as many as may differ are the same in both; those that
        aren't seen as shared must then be among the buckets frequent in it.
        """
        fit = pairs.join(side("a"), "a").join(side("b"), "b").where("a_head <> b_head AND 4 * a_largest >= 3 * b_smallest AND 4 * b_largest >= 3 * a_smallest")
        if counted:
            differ = "(a_largest + b_largest) div 7"
            enough = " OR ".join(
                f"(least(a_band, b_band) % 2 = {k} AND {n} + a_{n} >= a_filled_{n} - {differ} AND {n} + b_{n} >= b_filled_{n} - {differ})" for k, n in enumerate(("even", "odd"))
            )
            fit = fit.where(f"a_largest <> a_smallest OR b_largest <> b_smallest OR {enough}")
        return fit.select(F.least("a_head", "b_head").alias("a"), F.greatest("a_head", "b_head").alias("b")).distinct()

    copies = classes.where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b"))
    candidates = staged(heads_of(met.where("kind = 0").groupBy("a", "b").agg(F.sum("even").alias("even"), F.sum("odd").alias("odd")), True), "candidates")
    first = candidates.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = staged(verified(texts, first), "verified").unionByName(copies)

    def apart(pairs: DataFrame) -> DataFrame:
        a, b = reached.select(F.col("node").alias("a"), F.col("component").alias("a_part")), reached.select(F.col("node").alias("b"), F.col("component").alias("b_part"))
        open_ = pairs.join(a, "a", "left").join(b, "b", "left").where("coalesce(a_part, a) <> coalesce(b_part, b)")
        return open_.select("a", "b")

    # Two steps down the links so far: what they join already needs no comparison.
    parent = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    above = parent.select(F.col("node").alias("component"), F.col("component").alias("top"))
    reached = staged(parent.join(above, "component", "left").select("node", F.coalesce("top", "component").alias("component")), "parents")
    rest = staged(apart(candidates.join(first, ["a", "b"], "left_anti")), "rest")
    if not rest.isEmpty():
        links = links.unionByName(staged(verified(texts, rest), "verified"))
    reached = staged(components(links), "components")

    # Documents of large groups that may share no other bucket with a document alike. They share then at
    # least `spare` frequent keys, so one of the rarest `keys - spare + 1` of either, too.
    weak = []
    for parity, name in enumerate(("even", "odd")):
        own = hot.where(F.col("key").bitwiseAND(1) == parity).join(known.where(f"doc_id = head AND {name} > 0 AND {name} >= spare_{name}"), "doc_id")
        weak.append(own.select("key", "often", F.col("doc_id").alias("node"), F.col(f"spare_{name}").alias("spare"), F.lit(parity).alias("parity")))
    rarest = Window.partitionBy("node", "parity").orderBy("often", "key")
    ranked = weak[0].unionByName(weak[1]).withColumn("place", F.row_number().over(rarest)).withColumn("keys", F.count("*").over(Window.partitionBy("node", "parity")))
    asked = ranked.where("place <= keys - greatest(spare, 1) + 1").select("key", "node", "parity")
    placed = staged(asked.join(reached, "node", "left").select("key", "node", "parity", F.coalesce("component", "node").alias("part")), "weak")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    units = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j"))))
    spread = placed.join(_once(placed), "key").withColumn("blocks", blocks).withColumn("block", block).withColumn("unit", units)
    brief = classes.select(F.col("doc_id").alias("node"), "band", F.col("largest").alias("size"), "sketch")
    rows = spread.join(brief, "node").select("key", F.col("unit.i").alias("i"), F.col("unit.j").alias("j"), "node", "part", "parity", "band", "size", "sketch")
    shared = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_near_pairs, _LINKS)
    last = staged(heads_of(shared.distinct(), False).join(candidates, ["a", "b"], "left_anti"), "last")
    if not last.isEmpty():
        links = links.unionByName(staged(verified(texts, last), "verified"))
        reached = components(links)
    found = stats.join(reached.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
