"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked ids.

Both tokenizers start anew at a single space before a character that is no white space, so a text
falls into stretches that can be encoded, aligned and linked once for each distinct one. In a run of
documents (a slice) every token points to the token of the other kind that reaches farthest to the
right over it; doubling these steps leads all tokens of a group to its last token, which names it.

Ids that are linked are counted per slice, and the sums go by ranges of the B id to tasks that add
them up (per salt first), find the highest count of each B id, and answer each slice's pairs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import slices, take_ranges
from oreflow.llm.packed import batch_of, cells, pack, unpack
from oreflow.session import staged

SPACE = "▁"
#: Bytes of text aligned together.
SLICE = 2 << 20
#: Most parts that the B ids are dealt to: with 50,000 by 32,000 ids a part has at most 2 million pairs.
PARTS_LOG = 10
#: Slices that one task answers for one part.
SLICES_A_SALT = 512
#: Sums of pairs held before they are added up.
HELD = 4_000_000
#: Words that the tokenizers get at a time.
TOGETHER = 10_000

# Fixed value: the pattern that byte-level BPE cuts texts with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SPREAD = 0x9E3779B1  # odd, so that id -> id * _SPREAD modulo 2**32 can be undone


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for a pair of ids; the upper half is the spread B id alone."""
    return ((b.astype(np.uint64) * np.uint64(_SPREAD)) & np.uint64(0xFFFFFFFF)) << np.uint64(32) | a.astype(np.uint64)


def _surface_of_bytes() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class _Decimals:
    """Decimal texts of ids as bytes."""

    def __init__(self, n: int):
        texts = [str(i).encode() for i in range(n)]
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)


class TokenizerPair:
    """Tokenizer A (byte-level, over a space and the text) and B (pieces, which adds the space itself)."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks_of(byte_path), special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece holds a space after another character: texts can't be cut at spaces")
        surfaces = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(self.a.decode_single_token_bytes(i)) for i in range(self.a.n_vocab)], np.int64)
        self.b_sizes = np.array([len(x) for x in surfaces], np.int64)
        self.b_starts = np.cumsum(self.b_sizes) - self.b_sizes
        self.b_data = np.frombuffer(b"".join(surfaces), np.uint8)
        self.decimals = _Decimals(max(len(self.a_sizes), len(self.b_sizes)))

    def encoded(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """A ids, their number in each word (a space and the word), B ids, their number; no ids where tokens are not the word.

        Words start and end without white space, so one call of A takes many of them, joined by spaces.
        """
        raw = (" " + " ".join(words)).encode()
        sizes = np.array([len(w.encode()) + 1 for w in words], np.int64)
        ends = np.cumsum(sizes)
        a = np.array(self.a.encode_ordinary(raw.decode()), np.int64)
        n_a = np.diff(np.searchsorted(np.cumsum(self.a_sizes[a]), ends, side="right"), prepend=0)
        lists = self.b.encode(words, num_threads=1)
        n_b = np.fromiter(map(len, lists), np.int64, len(lists))
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(n_b.sum()))
        surface = take_ranges(self.b_data, self.b_starts[b], self.b_sizes[b]).tobytes()
        if surface != raw:
            owner = np.repeat(np.arange(len(words)), n_b)
            reach = _ranges_of(np.bincount(owner, weights=self.b_sizes[b], minlength=len(words)).astype(np.int64)).tolist()
            good = np.array([surface[x:y] == raw[e - n : e] for x, y, e, n in zip(reach, reach[1:], ends.tolist(), sizes.tolist(), strict=False)], bool)
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        return a, n_a, b, n_b

    def encoded_all(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """The same for any words, in runs of some thousands; those with white space at an end go alone."""
        found, held = [], []
        for word in words:
            alone = not word or word[0].isspace() or word[-1].isspace()
            if held and (alone or len(held) >= TOGETHER):
                found.append(self.encoded(held))
                held = []
            if alone:
                found.append(self.encoded([word]))
            else:
                held.append(word)
        if held:
            found.append(self.encoded(held))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 4


def ranks_of(path: str) -> dict[bytes, int]:
    """Bytes and id of every entry of a byte-level BPE file, whose ids must follow its merges."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    cut = model["pre_tokenizer"]
    if cut["type"] != "ByteLevel" or not cut.get("use_regex", True) or model["normalizer"] is not None:
        raise ValueError("not a byte-level tokenizer with its usual pattern")
    entries, stands = model["model"]["vocab"], _surface_of_bytes()
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["model"]["merges"]]
    if [entries[m] for m in merges] != list(range(256, 256 + len(merges))):
        raise ValueError("ids do not follow the merges")
    return {bytes(map(stands.__getitem__, text)): i for text, i in entries.items() if i < 256 + len(merges)}


#: Where both tokenizers start anew inside a space and a text.
_CUT = regex.compile(r"(?<! ) (?=[^\s\x1c-\x1f])")
_ODD = "^ |  | [\\t-\\r\\x1c-\\x1f\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"


def _stretches(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Stretches of all texts less the space each starts with, and each text's first; an empty text has none."""
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False) | pc.ends_with(texts, " ").to_numpy(zero_copy_only=False)
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, " ").cast(pa.list_(pa.string()))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(counts)])
    flat, parts, done = lists.flatten(), [], 0
    for k in np.flatnonzero(odd | empty).tolist():
        text = texts[k].as_py()
        own = []
        if text:
            # The space in front belongs to the text: a text that starts with one starts with two.
            whole = " " + text
            cuts = [0, *(m.start() for m in _CUT.finditer(whole, 1)), len(whole)]
            own = [whole[a + 1 : b] for a, b in zip(cuts, cuts[1:], strict=False)]
        parts += [flat.slice(ends[done], ends[k] - ends[done]), pa.array(own, pa.string())]
        counts[k], done = len(own), k + 1
    parts.append(flat.slice(ends[done]))
    return pa.concat_arrays(parts), np.concatenate([[0], np.cumsum(counts)])


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of every A and every B token, numbered from the left, by pointer jumping.

    Both rows of tokens cover the same bytes. A token points to the token of the other kind over its
    last byte; a B token that ends where that one does is the last of its group and points to itself.
    """
    n_a, n_b = len(a_ends), len(b_ends)
    to_b = np.searchsorted(b_ends, a_ends - 1, side="right")
    to_a = np.searchsorted(a_ends, b_ends - 1, side="right")
    last = a_ends[to_a] == b_ends
    jump = np.concatenate([n_a + to_b, np.where(last, n_a + np.arange(n_b), to_a)])
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        jump = further
    number = np.cumsum(last) - 1
    label = number[jump - n_a]
    return label[:n_a], label[n_a:]


def links_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A token, B token and end byte of every link: between two neighbouring ends lies one overlap."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends - 1, side="right"), np.searchsorted(b_ends, ends - 1, side="right"), ends


def _ranges_of(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on at the fewest bytes, all lowest bytes first: upper ones compress well."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    n = (len(raw) - 1) // raw[0]
    out = np.zeros((n, 8), np.uint8)
    out[:, : raw[0]] = np.frombuffer(raw, np.uint8, -1, 1).reshape(raw[0], n).T
    return out.view("<i8")[:, 0]


class _Aligned:
    """Everything that the distinct stretches of a slice need: numbers of tokens, groups and links, texts of groups."""

    def __init__(self, pair: TokenizerPair, words: list[str]):
        a, self.n_a, b, self.n_b = pair.encoded_all(words)
        self.good = self.n_a > 0
        a_ends, b_ends = np.cumsum(pair.a_sizes[a]), np.cumsum(pair.b_sizes[b])
        of_a, of_b = groups_of(a_ends, b_ends) if len(a) else (a, b)
        at_a, at_b, _ = links_of(a_ends, b_ends) if len(a) else (a, b, a)
        owner_b = np.repeat(np.arange(len(words)), self.n_b)
        last = np.flatnonzero(np.append(of_b[1:] != of_b[:-1], True)) if len(b) else b
        self.n_groups = np.bincount(owner_b[last], minlength=len(words))
        self.link_owner = owner_b[at_b]
        self.n_links = np.bincount(self.link_owner, minlength=len(words))
        self.link_keys = pair_keys(a[at_a], b[at_b])
        self._texts(pair.decimals, a, b, of_a, of_b)

    def _texts(self, decimals: _Decimals, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> None:
        """`a1,a2|b1;` of every group in order, as one buffer with the range of each stretch."""
        ids, group = np.concatenate([a, b]), np.concatenate([of_a, of_b])
        kind = np.repeat(np.array([0, 1]), [len(a), len(b)])
        order = np.argsort(2 * group + kind, kind="stable")
        ids, unit = ids[order], (2 * group + kind)[order]
        ends = np.append(unit[1:] != unit[:-1], True) if len(unit) else np.empty(0, bool)
        mark = np.where(ends, np.where(unit % 2 == 0, ord("|"), ord(";")), ord(",")).astype(np.uint8)
        sizes = decimals.sizes[ids] + 1
        # The byte after each decimal is a place holder that the mark takes.
        data = np.empty(int(sizes.sum()), np.uint8)
        after = np.cumsum(sizes) - 1
        body = np.ones(len(data), bool)
        body[after] = False
        data[body] = take_ranges(decimals.data, decimals.starts[ids], decimals.sizes[ids])
        data[after] = mark
        owner = np.concatenate([np.repeat(np.arange(len(self.n_a)), self.n_a), np.repeat(np.arange(len(self.n_b)), self.n_b)])[order]
        lengths = np.bincount(owner, weights=sizes, minlength=len(self.n_a)).astype(np.int64)
        ends_of = _ranges_of(lengths).tolist()
        raw = data.tobytes()
        self.texts = [raw[x:y] for x, y in zip(ends_of, ends_of[1:], strict=False)]


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _slice_row(number: int, batch: pa.RecordBatch, pair: TokenizerPair) -> dict:
    texts = batch.column(1).fill_null("").cast(pa.string())
    words, firsts = _stretches(texts)
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # Frequent stretches get small numbers.
    by_use = np.argsort(-np.bincount(index, minlength=len(coded.dictionary)), kind="stable")
    number_of = np.empty(len(by_use), np.int64)
    number_of[by_use] = np.arange(len(by_use))
    index = number_of[index]
    aligned = _Aligned(pair, coded.dictionary.take(pa.array(by_use)).to_pylist())
    counts = np.diff(firsts)
    doc = np.repeat(np.arange(len(texts)), counts)
    whole = np.bincount(doc, weights=~aligned.good[index], minlength=len(texts)) == 0
    index, counts = index[np.repeat(whole, counts)], np.where(whole, counts, 0)
    firsts = _ranges_of(counts)
    digests = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        joined_texts = b"".join(map(aligned.texts.__getitem__, index[a:b].tolist()))
        digests.append(hashlib.sha256(joined_texts[:-1]).hexdigest() if joined_texts else "")
    used = np.bincount(index, minlength=len(aligned.good))
    weight = used[aligned.link_owner]
    here = weight > 0
    keys, inverse = np.unique(aligned.link_keys[here], return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, inverse, weight[here])
    per_link = np.bincount(aligned.link_owner[here], minlength=len(aligned.good))
    sums = {name: np.diff(np.concatenate([[0], np.cumsum(getattr(aligned, name)[index])])[firsts], prepend=0)[1:] for name in _NUMBERS}
    return {
        "slice": number, "ids": batch.column(0).to_pylist(), "digests": digests, **{name: sums[name].tolist() for name in _NUMBERS},
        "n_stretches": _planes(counts), "stretches": _planes(index), "stretch_links": _planes(per_link), "links": _planes(inverse), "pairs": pack(keys, totals, np.zeros(len(keys), np.int64)),
    }


def _slices(batches: Iterator[pa.RecordBatch], byte_path: str, piece_path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    pair, number = TokenizerPair(byte_path, piece_path), TaskContext.get().partitionId() << 32
    for batch in (part for whole in batches for part in slices(whole, 1, SLICE)):
        yield pa.RecordBatch.from_pylist([_slice_row(number, batch, pair)], schema)
        number += 1


_CUTS = "part long, salt int, slice long, payload binary"


def _cuts(batches: Iterator[pa.RecordBatch], bits: int, salts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = batch_of(list(cells(*unpack(raw), bits)))
            n, salt = rows.num_rows, ((number >> 32) * 31 + (number & 0xFFFFFFFF)) % salts
            columns = [rows.column(0), pa.array([salt] * n, pa.int32()), pa.array([number] * n, pa.int64()), rows.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "salt", "slice", "payload"])


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, inverse, np.concatenate([x[1] for x in held]))
    return keys, totals


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One payload of sums for each part in this task; rows come sorted by part."""
    own, held, size = None, [], 0
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part != own and held:
                keys, totals = _merged(held)
                yield batch_of([(own, pack(keys, totals, np.zeros(len(keys), np.int64)))])
                held, size = [], 0
            own = part
            held.append(unpack(raw)[:2])
            size += len(held[-1][0])
            if size > HELD:
                held = [_merged(held)]
                size = 0
    if held:
        keys, totals = _merged(held)
        yield batch_of([(own, pack(keys, totals, np.zeros(len(keys), np.int64)))])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each cut of a slice the counts of its pairs, and whether that is the highest of the B id.

    The totals of a part come before the cuts that ask for them.
    """
    keys = totals = best = None
    for batch in batches:
        out = []
        for number, part, raw in zip(batch.column(2).to_pylist(), batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
            asked, counts, _ = unpack(raw)
            if number < 0:
                keys, totals = asked, counts
                of_b = keys >> np.uint64(32)
                starts = np.flatnonzero(np.append(True, of_b[1:] != of_b[:-1]))
                best = totals == np.repeat(np.maximum.reduceat(totals, starts), np.diff(np.append(starts, len(keys))))
            else:
                at = np.searchsorted(keys, asked)
                out.append((number, part, _planes(totals[at] << 1 | best[at])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["slice", "part", "answer"])


def _closed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of documents from the row of each slice and its answers in order of part."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            answers = [x["answer"] for x in sorted(row["answers"] or (), key=lambda x: x["part"])]
            told = np.concatenate([_numbers(x) for x in answers] or [np.empty(0, np.int64)])
            counts, best = told >> 1, told & 1
            links, stretches = _numbers(row["links"]), _numbers(row["stretches"])
            ends, firsts = _ranges_of(_numbers(row["stretch_links"])), _ranges_of(_numbers(row["n_stretches"]))
            out = {"doc_id": row["ids"], **{name: row[name] for name in _NUMBERS}}
            for name, values in (("n_best", best), ("count_sum", counts)):
                each = np.diff(_ranges_of(values[links])[ends])
                out[name] = np.diff(_ranges_of(each[stretches])[firsts])
            out["groups_sha256"] = row["digests"]
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)


def align_tokens(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    A null or empty text, and one whose joined tokens of either kind are not a space and the text, has
    zeros and an empty digest and counts nowhere. Rows are taken one by one: repeated rows and ids, and
    null ids, are each aligned, counted and returned. A text without a space is one stretch of any
    length. Further columns are ignored; an empty table gives no rows. Equal counts are all the best of
    their B id. The tokenizer files must be readable at the same paths on every machine.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind, long = rows.schema["doc_id"].dataType, T.LongType()
    lists = [T.StructField(n, T.ArrayType(long)) for n in _NUMBERS]
    binaries = [T.StructField(n, T.BinaryType()) for n in ("n_stretches", "stretches", "stretch_links", "links", "pairs")]
    schema = T.StructType([T.StructField("slice", long), T.StructField("ids", T.ArrayType(kind)), T.StructField("digests", T.ArrayType(T.StringType())), *lists, *binaries])
    state = staged(rows.mapInArrow(partial(_slices, byte_path=byte_path, piece_path=piece_path, schema=to_arrow_schema(schema)), schema), "aligned-slices")
    n_slices, n_pairs = state.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("pairs")), F.lit(0))).first()
    bits = min(PARTS_LOG, max(4, (n_pairs // (32 << 20)).bit_length()))
    salts = 1 + n_slices // SLICES_A_SALT
    cuts = state.select("slice", "pairs").mapInArrow(partial(_cuts, bits=bits, salts=salts), _CUTS)
    by_salt = cuts.repartition("part", "salt").sortWithinPartitions("part").select("part", "payload").mapInArrow(_added, "part long, payload binary")
    totals = staged(by_salt.repartition("part").sortWithinPartitions("part").mapInArrow(_added, "part long, payload binary"), "pair-counts")
    every = totals.select("part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(-1).cast("long").alias("slice"), "payload")
    asked = every.unionByName(cuts).repartition("part", "salt").sortWithinPartitions("part", "salt", "slice")
    answers = asked.mapInArrow(_answers, "slice long, part long, answer binary")
    by_slice = answers.groupBy("slice").agg(F.collect_list(F.struct("part", "answer")).alias("answers"))
    out = T.StructType([T.StructField("doc_id", kind), *[T.StructField(n, long) for n in (*_NUMBERS, "n_best", "count_sum")], T.StructField("groups_sha256", T.StringType())])
    return state.drop("pairs").join(by_slice, "slice", "left").mapInArrow(partial(_closed, schema=to_arrow_schema(out)), out)
