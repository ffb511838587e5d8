"""Removal of every byte under a byte string of fixed length that starts anywhere else as well.

A string of 400 bytes is dealt by its minimizer: the least hash of the 200-byte strings inside it, the
leftmost at ties. Equal strings have equal minimizers, so they meet. Neighbouring strings with one
minimizer travel as one stretch of text, first by hash alone:

* stretches that are equal as a whole (128 bits) are all repeated, and known to be;
* a stretch whose minimizer occurs nowhere else holds nothing that is repeated;
* different stretches under one minimizer send their text, one for each distinct stretch, and their
  strings are put in suffix order (`suffix_order`): neighbours that are equal are repeated;
* a minimizer with very many different stretches is dealt anew, string by string.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import mix, rolling, slices, text_buffers
from oreflow.llm.packed import CELLS, batch_of, group_sizes, group_starts, pack, parts_of, unpack
from oreflow.llm.suffix_order import ordered
from oreflow.session import staged

LENGTH = 400
#: Bytes of text (strings that start there) worked on together.
SLICE = 3 << 20
#: Different stretches under one minimizer that are ordered together; more are dealt string by string.
GROUP = 4096
#: Stretches of one minimizer over all slices that one task receives, at most about so many.
RECEIVED = 1 << 22
#: Bytes of stretches ordered together: whole minimizers up to this size.
UNIT = 1 << 20

_CODES = np.random.default_rng(0x5AFF1C).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_GRAM, _WHOLE = 0xA24BAED4963EE407, 0x9FB21C651E98DF25
#: Kinds of messages to a document.
REPEATED, ORDER, SINGLY = 0, 1, 2
_RUN = 9  # bits of a stretch's number of strings; a longer run of strings is several


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of every `width` neighbouring hashes, the leftmost at ties."""
    value, place, span = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        right = value[step:] < value[:-step]
        value, place = np.where(right, value[step:], value[:-step]), np.where(right, place[step:], place[:-step])
        span += step
    return place


def _prefix_hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of code times power up to every place, and the inverse powers: any stretch's hash from two of them."""
    with np.errstate(over="ignore"):
        power = np.full(len(codes) + 1, np.uint64(_WHOLE | 1))
        power[0] = 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * np.multiply.accumulate(power)[:-1], dtype=np.uint64)])
        power[1:] = np.uint64(pow(_WHOLE | 1, -1, 1 << 64))
        return sums, np.multiply.accumulate(power)


def _stretch_hashes(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return mix((sums[starts + sizes] - sums[starts]) * inverse[starts])


class Stretches:
    """Stretches of the texts of a slice: `row`, `place`, `run` (strings), and two hashes, of minimizer and stretch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        gram = length // 2
        found = []
        owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        for low in range(0, max(1, len(data) - length + 1), SLICE):
            part = data[low : low + SLICE + length - 1]
            if len(part) < length:
                break
            codes = _CODES[part]
            grams = mix(rolling(codes, gram, _GRAM))
            anchor = _least(grams, length - gram + 1)
            sums, inverse = _prefix_hashes(codes)
            row = owner[low : low + len(anchor)]
            inside = np.flatnonzero(low + np.arange(len(anchor)) + length <= offsets[row + 1])
            if not len(inside):
                continue
            row, anchor = row[inside], anchor[inside]
            first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])))
            run = np.diff(np.append(first, len(inside)))
            starts, row, anchor = inside[first], row[first], anchor[first]
            whole = _stretch_hashes(sums, inverse, starts, run + length - 1)
            # Least hashes are small; mixed again they spread over all parts.
            found.append((row, starts + low - offsets[row], run, mix(grams[anchor]), whole))
        empty = [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2
        self.row, self.place, self.run, self.key, self.whole = (np.concatenate(x) for x in zip(*found, strict=True)) if found else empty


def _noted(docs: np.ndarray, places: np.ndarray, runs: np.ndarray) -> bytes:
    """Runs of repeated strings; neighbours become one, up to what the run's bits hold."""
    order = np.lexsort((places, docs))
    docs, places, runs = docs[order], places[order], runs[order]
    joins = np.append(False, (docs[1:] == docs[:-1]) & (places[1:] == places[:-1] + runs[:-1]))
    chain = np.cumsum(~joins) - 1
    first = np.flatnonzero(~joins)
    total = np.bincount(chain, weights=runs).astype(np.int64) if len(runs) else runs
    most = (1 << _RUN) - 1
    pieces = -(-total // most)
    nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    own = np.repeat(np.arange(len(first)), pieces)
    places = places[first][own] + nth * most
    runs = np.minimum(total[own] - nth * most, most)
    return pack(np.zeros(len(own), np.uint64), docs[first][own], places << _RUN | runs)


def _dealt(kind: int, docs: np.ndarray, places: np.ndarray, runs: np.ndarray, bits: int, flags: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
    """Messages to documents, by ranges of the hash that names a document."""
    part = docs.astype(np.uint64) >> np.uint64(64 - bits)
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = group_starts(part)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True) if len(part) else ():
        own = order[a:b]
        if kind == REPEATED:
            raw = _noted(docs[own], places[own], runs[own])
        else:
            raw = pack(np.zeros(b - a, np.uint64), docs[own], (places[own] << _RUN | runs[own]) << 1 | (0 if flags is None else flags[own]))
        yield int(part[a]), bytes([kind]) + raw


def _cut_by_key(key: np.ndarray, whole: np.ndarray, docs: np.ndarray, numbers: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """Rows in order of key, cut by its upper bits; the second hash follows as it is."""
    parts = key >> np.uint64(64 - bits)
    starts = group_starts(parts)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True) if len(key) else ():
        yield int(parts[a]), pack(key[a:b], docs[a:b], numbers[a:b]) + whole[a:b].tobytes()


def _rows_of(payload: bytes) -> tuple[np.ndarray, ...]:
    key, docs, numbers = unpack(payload)
    return key, np.frombuffer(payload, np.uint64, len(key), len(payload) - 8 * len(key)), docs, numbers


def _combined(found: Stretches, docs: np.ndarray, bits: int, crowded: int | None) -> Iterator[tuple[int, bytes]]:
    """Rows of a slice: each distinct stretch once, and whether it came more than once; the copies are known to be repeated.

    A minimizer with over `crowded` different stretches here sends a mark (a stretch of no strings) in their place,
    and its stretches are dealt string by string wherever they are.
    """
    docs = docs[found.row]
    order = np.lexsort((found.whole, found.key))
    key, whole, docs, place, run = found.key[order], found.whole[order], docs[order], found.place[order], found.run[order]
    if not len(key):
        return
    new_key = np.append(True, key[1:] != key[:-1])
    new = new_key | np.append(True, whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(key)))
    many = np.repeat(size > 1, size)
    if many.any():
        for part, raw in _dealt(REPEATED, docs[many], place[many], run[many], bits):
            yield -1 - part, raw
    key, whole, docs, place, run, many = key[first], whole[first], docs[first], place[first], run[first], size > 1
    numbers = (place << _RUN | run) << 1 | many
    if crowded is not None:
        starts = np.flatnonzero(new_key[first])
        sizes = np.diff(np.append(starts, len(key)))
        full = np.repeat(sizes > crowded, sizes)
        if full.any():
            own = full & ~many
            for part, raw in _dealt(SINGLY, docs[own], place[own], run[own], bits):
                yield -1 - part, raw
            marks = starts[sizes > crowded]
            numbers[marks] = 0
            full[marks] = False
            # The witness of copies among them is a string like any other.
            own = np.repeat(sizes > crowded, sizes) & many
            for part, raw in _dealt(SINGLY, docs[own], place[own], run[own], bits, np.ones(len(docs), np.int64)):
                yield -1 - part, raw
            key, whole, docs, numbers = key[~full], whole[~full], docs[~full], numbers[~full]
    yield from _cut_by_key(key, whole, docs, numbers, bits)


def _stretch_rows(batches: Iterator[pa.RecordBatch], length: int, bits: int, crowded: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1, SLICE)):
        found = Stretches(*text_buffers(batch.column(1)), length)
        yield batch_of(list(_combined(found, batch.column(0).to_numpy(), bits, crowded)))


def _messages(batches: Iterator[pa.RecordBatch], bits: int, group: int) -> Iterator[pa.RecordBatch]:
    """What each document has to do about its stretches, from all stretches of a range of minimizers."""
    for part, payloads in parts_of(batches):
        if part < 0:
            yield batch_of([(-1 - part, x) for x in payloads])
            continue
        key, whole, docs, numbers = (np.concatenate(x) for x in zip(*map(_rows_of, payloads), strict=True))
        order = np.lexsort((whole, key))
        key, whole, docs, numbers = key[order], whole[order], docs[order], numbers[order]
        many, run, place = numbers & 1, numbers >> 1 & ((1 << _RUN) - 1), numbers >> (_RUN + 1)
        new_key = np.append(True, key[1:] != key[:-1])
        new = new_key | np.append(True, whole[1:] != whole[:-1])
        starts, firsts = np.flatnonzero(new_key), np.flatnonzero(new)
        sizes = np.diff(np.append(firsts, len(key)))
        copies = np.repeat(sizes, sizes) + many > 1
        different = np.add.reduceat(new.astype(np.int64), starts)
        marked = np.add.reduceat((run == 0).astype(np.int64), starts) > 0
        full = marked | (different > group)
        keys = np.diff(np.append(starts, len(key)))
        full, different = np.repeat(full, keys), np.repeat(different, keys)
        real = run > 0
        out = list(_dealt(REPEATED, *(x[copies & real & (many == 0)] for x in (docs, place, run)), bits))
        for kind, chosen in ((SINGLY, full & new & real), (ORDER, ~full & new & (different > 1))):
            own = (x[chosen] for x in (docs, place, run))
            out += _dealt(kind, *own, bits, np.where(copies, 1, 0)[chosen])
        yield batch_of(out)


_LISTS = T.StructType([T.StructField("row", T.LongType()), T.StructField("kinds", T.BinaryType()), T.StructField("numbers", T.ArrayType(T.LongType()))])


def _by_document(batches: Iterator[pa.RecordBatch], wanted: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """One row for each document with its messages of the wanted kinds."""
    for _, payloads in parts_of(batches):
        chosen = [x for x in payloads if x[0] in wanted]
        if not chosen:
            continue
        lists = [unpack(x[1:])[1:] for x in chosen]
        kinds = np.repeat(np.array([x[0] for x in chosen], np.uint8), [len(x[0]) for x in lists])
        docs, numbers = (np.concatenate(x) for x in zip(*lists, strict=True))
        order = np.argsort(docs, kind="stable")
        docs, numbers, kinds = docs[order], numbers[order], kinds[order]
        starts = group_starts(docs)
        ends = np.append(starts[1:], len(docs))
        held = pa.ListArray.from_arrays(pa.array(np.append(starts, len(docs)), pa.int32()), pa.array(numbers))
        raw = kinds.tobytes()
        of_kind = pa.array([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(docs[starts]), of_kind, held], names=["row", "kinds", "numbers"])


def _texts(batches: Iterator[pa.RecordBatch], length: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Texts of the stretches to be ordered by their minimizer, and strings dealt singly by their own hash."""
    gram = length // 2
    for batch in (part for whole in batches for part in slices(whole, 1, SLICE)):
        data, offsets = text_buffers(batch.column(1))
        rows = batch.column(0).to_numpy()
        lists = batch.column(3)
        numbers = lists.flatten().to_numpy()
        counts = lists.value_lengths().to_numpy()
        kinds = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8)
        owner = np.repeat(np.arange(len(rows)), counts)
        many, run, place = numbers & 1, numbers >> 1 & ((1 << _RUN) - 1), numbers >> (_RUN + 1)
        begin = offsets[owner] + place
        out: list[tuple[int, bytes]] = []
        own = np.flatnonzero(kinds == ORDER)
        units: dict[int, list] = {}
        for k in own.tolist():
            text = data[begin[k] : begin[k] + run[k] + length - 1]
            # The minimizer of all the stretch's strings is that of its first.
            key = int(mix(mix(rolling(_CODES[text[:length]], gram, _GRAM)).min(keepdims=True))[0])
            units.setdefault(key >> (64 - bits), []).append((key, int(rows[owner[k]]), int(place[k]), int(run[k]), int(many[k]), text.tobytes()))
        for part, held in units.items():
            head = np.array([x[:1] for x in held], np.uint64).tobytes() + np.array([x[1:5] for x in held], np.int64).tobytes()
            out.append((part, bytes([ORDER]) + len(held).to_bytes(4, "little") + head + b"".join(x[5] for x in held)))
        single = np.flatnonzero(kinds == SINGLY)
        if len(single):
            out += _single_rows(data, rows, owner, place, begin, run, many, single, length, bits)
        yield batch_of(out)


def _single_rows(data, rows, owner, place, begin, run, many, chosen, length, bits) -> Iterator[tuple[int, bytes]]:
    """The strings of the chosen stretches as rows of their own; those met twice here are known to be repeated."""
    # Only the bytes under the chosen stretches, one behind the other.
    sizes = run[chosen] + length - 1
    ends = np.cumsum(sizes)
    text = data[np.repeat(begin[chosen] - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
    sums, inverse = _prefix_hashes(_CODES[text])
    runs = run[chosen]
    of = np.repeat(np.arange(len(chosen)), runs)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)
    starts = (ends - sizes)[of] + nth
    whole = _stretch_hashes(sums, inverse, starts, np.full(len(of), length))
    found = Stretches.__new__(Stretches)
    found.row, found.place, found.run = owner[chosen][of], place[chosen][of] + nth, np.ones(len(of), np.int64)
    second = np.uint64(_GRAM | 1)
    grams = rolling(_CODES[text], length, _GRAM)[starts]
    found.key, found.whole = mix(grams * second), whole
    # A witness of copies counts for two: its strings come twice.
    twice = many[chosen][of] > 0
    for name in ("row", "place", "run", "key", "whole"):
        value = getattr(found, name)
        setattr(found, name, np.concatenate([value, value[twice]]))
    for part, raw in _combined(found, rows, bits, None):
        yield (part, bytes([SINGLY]) + raw) if part >= 0 else (part, raw)


def _repeated_in(held: list[tuple[np.ndarray, np.ndarray, bytes]], length: int) -> tuple[np.ndarray, ...]:
    """doc, place and run of the repeated strings of some texts, by their suffix order."""
    heads = np.concatenate([x[1] for x in held])
    data = np.frombuffer(b"".join(x[2] for x in held), np.uint8)
    docs, places, runs, many = heads.T
    sizes = runs + length - 1
    begins = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(runs)), runs)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)
    order, equal = ordered(data, begins[of] + nth, length)
    of, nth = of[order], nth[order]
    group = np.cumsum(~equal) - 1
    weight = np.bincount(group, weights=1 + many[of])
    found = (weight[group] > 1) & (many[of] == 0)
    return docs[of[found]], places[of[found]] + nth[found], np.ones(int(found.sum()), np.int64)


def _units(payloads: list[bytes], length: int) -> Iterator[list[tuple[np.ndarray, np.ndarray, bytes]]]:
    """The stretches of a part in order of minimizer, whole minimizers at a time."""
    texts = []
    for raw in payloads:
        n = int.from_bytes(raw[1:5], "little")
        keys = np.frombuffer(raw, np.uint64, n, 5).tolist()
        heads = np.frombuffer(raw, np.int64, 4 * n, 5 + 8 * n).reshape(n, 4)
        at = 5 + 40 * n
        for k in range(n):
            size = int(heads[k, 2]) + length - 1
            texts.append((keys[k], heads[k : k + 1], raw[at : at + size]))
            at += size
    texts.sort(key=lambda x: x[0])
    held, size = [], 0
    for k, x in enumerate(texts):
        if size > UNIT and x[0] != texts[k - 1][0]:
            yield held
            held, size = [], 0
        held.append(x)
        size += len(x[2])
    if held:
        yield held


def _decided(batches: Iterator[pa.RecordBatch], length: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings among the texts and the single strings of each part."""
    for part, payloads in parts_of(batches):
        if part < 0:
            yield batch_of([(-1 - part, x) for x in payloads])
            continue
        for unit in _units([x for x in payloads if x[0] == ORDER], length):
            yield batch_of(list(_dealt(REPEATED, *_repeated_in(unit, length), bits)))
        single = [x[1:] for x in payloads if x[0] == SINGLY]
        if single:
            key, whole, docs, numbers = (np.concatenate(x) for x in zip(*map(_rows_of, single), strict=True))
            order = np.lexsort((whole, key))
            key, whole, docs, numbers = key[order], whole[order], docs[order], numbers[order]
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])))
            sizes = group_sizes(first, len(key))
            found = (np.repeat(sizes, sizes) > 1) & (numbers & 1 == 0)
            yield batch_of(list(_dealt(REPEATED, docs[found], numbers[found] >> (_RUN + 1), numbers[found] >> 1 & ((1 << _RUN) - 1), bits)))


_KEPT = [*(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType())]


def _kept(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1, SLICE)):
        data, offsets = text_buffers(batch.column(1))
        sizes = np.diff(offsets)
        out: dict[str, list] = {"n_removed": [], "n_spans": [], "spans": [], "kept": []}
        for k in range(batch.num_rows):
            text = data[offsets[k] : offsets[k + 1]]
            numbers = batch.column(2)[k]
            spans = np.empty(0, np.int64)
            if numbers.is_valid and len(text):
                numbers = numbers.values.to_numpy()
                place, run = numbers >> _RUN, numbers & ((1 << _RUN) - 1)
                cover = np.zeros(len(text) + 1, np.int64)
                np.add.at(cover, place, 1)
                np.add.at(cover, place + run + length - 1, -1)
                gone = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
                spans = np.flatnonzero(gone[1:] != gone[:-1])
                text = text[~gone[1:-1]]
            out["n_removed"].append(int(sizes[k]) - len(text))
            out["n_spans"].append(len(spans) // 2)
            out["spans"].append(spans)
            out["kept"].append(text.tobytes())
        arrays = [batch.column(0), pa.array(sizes), pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()), pa.array(out["spans"], pa.list_(pa.int64())), pa.array(out["kept"], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])


def _together(cut: DataFrame, tasks: int) -> DataFrame:
    """All rows of a part in one task, next to each other."""
    return cut.repartition(tasks, "part").sortWithinPartitions("part")


def repeated_strings(rows: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """row and numbers (place * 512 + run of strings) of the repeated strings of texts named by the long `row`."""
    if not 2 * 8 <= length <= 2 * (1 << _RUN) - 4:
        raise ValueError(f"length must be 16 to {2 * (1 << _RUN) - 4} bytes")
    long = rows.where(F.octet_length("text") >= length)
    total = long.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About 100,000 stretches a part, each of a quarter of the length; parts of some 32 MB of text to a task.
    bits = max(4, (total // (100_000 * length // 4)).bit_length())
    tasks = min(1 << bits, max(16, min(1 << 16, total >> 25)))
    crowded = max(2, min(group // 8, RECEIVED // (1 + total // SLICE)))
    together = partial(_together, tasks=tasks)
    cut = long.mapInArrow(partial(_stretch_rows, length=length, bits=bits, crowded=crowded), CELLS)
    told = staged(together(cut).mapInArrow(partial(_messages, bits=bits, group=group), CELLS), "repeat-messages")
    asked = together(told).mapInArrow(partial(_by_document, wanted=(ORDER, SINGLY)), _LISTS)
    sent = long.join(asked, "row").select("row", "text", "kinds", "numbers").mapInArrow(partial(_texts, length=length, bits=bits), CELLS)
    decided = together(sent).mapInArrow(partial(_decided, length=length, bits=bits), CELLS)
    return together(told.unionByName(decided)).mapInArrow(partial(_by_document, wanted=(REPEATED,)), _LISTS).select("row", "numbers")


def remove_repeated_strings(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (start, end, start, ... of removed bytes) and kept (the bytes left) of every row.

    A byte of a text's UTF-8 form goes if a string of `length` bytes over it also starts elsewhere, in
    the same text too; strings are judged on the input. A null text is empty. Rows are taken one by
    one, whatever their ids: of equal texts long enough nothing is left, though the ids be equal or
    null. What is kept may start or end inside a character. Texts of any length are cut into stretches
    and never shipped whole but to their own row. Further columns are ignored. `group`, the number of
    stretches under one minimizer that are ordered in one task, changes the plan and not the result.
    """
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("row"))
    found = repeated_strings(rows.select("row", "text"), length, group)
    schema = T.StructType([T.StructField("doc_id", kind), *_KEPT])
    return rows.join(found, "row", "left").select("doc_id", "text", "numbers").mapInArrow(partial(_kept, length=length), schema)
