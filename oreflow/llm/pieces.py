"""Merge-type piece encoding by backtracking, exact with the library that trained the model.

The text is cut where no piece of the vocabulary can reach across. Each part is encoded from left
to right: an Aho-Corasick automaton lists the pieces that start at a place, the longest that fits
the piece before it is taken, and a place from which nothing leads on is noted in a bit field and
never entered again. Two adjacent pieces fit if merging their joined characters by score ends at
these two pieces, which the joinings of each, done in turn, tell; a sequence whose neighbours all fit is the one result that merging the whole
text would give.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import lean, slices, take_ranges

SPACE = "▁"
#: Bytes that a Python worker remembers parts with, and fits with, at most; beyond that it forgets all and goes on.
REMEMBERED = 40 << 20
#: Characters of the longest part remembered, and bytes of an entry but for its characters.
REMEMBERED_LENGTH, ENTRY_BYTES = 64, 200
#: Bytes of a fit remembered: two numbers at most and their place in a dict.
FIT_BYTES = 160
#: Bytes of text encoded at a time, and ids decoded at a time, but for longer texts: bounds what numpy holds beside the results.
SLICE, DECODED_AT_ONCE = 2 << 20, 1 << 18


class PieceModel:
    """A model's pieces and scores, and the parts encoded so far."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in ids]
        self.ids = {model.id_to_piece(i): i for i in ids if not special[i]}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = model.unk_id()
        self.has_bytes = model.is_byte(self.byte_ids[0])
        self.pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.automaton = ahocorasick.Automaton()
        # Every place has its one character as an option anyhow.
        for p in self.ids:
            if len(p) > 1:
                self.automaton.add_word(p, len(p) - 1)
        self.automaton.make_automaton()
        self.names = {p: p for p in self.ids}
        self.traces: dict[str, tuple[tuple, ...] | None] = {}
        self.fits: dict[int, bool] = {}
        self.parts: dict[str, bytes] = {}
        self.fits_bytes = self.parts_bytes = 0
        surfaces = [b"" if model.is_control(i) else p.replace(SPACE, " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in ids)]
        for b, i in enumerate(self.byte_ids):
            if self.has_bytes:
                surfaces[i] = bytes([b])
        surfaces[self.unknown] = " ⁇ ".encode()
        self.surface_lengths = np.array([len(x) for x in surfaces], np.int64)
        self.surface_starts = np.cumsum(self.surface_lengths) - self.surface_lengths
        self.surface_bytes = np.frombuffer(b"".join(surfaces), np.uint8)

    def merges(self, piece: str) -> tuple[tuple, ...] | None:
        """How merging makes a piece of its characters; None if it makes something else of them.

        The neighbours whose joint piece scores highest are joined, the leftmost at ties, until none is left. Told are the score of
        each joining, with one that never comes at the end, and the first and the last symbol before each.
        """
        if len(piece) == 1:
            return (_NEVER,), (piece,), (piece,)
        known = self.traces.get(piece, False)
        if known is not False:
            return known
        symbols, find, own = list(piece), self.scores.get, self.names.get
        joint = [find(a + b, _NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        scores, firsts, lasts = [], [symbols[0]], [symbols[-1]]
        while joint:
            best = max(joint)
            if best == _NEVER:
                break
            at = joint.index(best)
            joined = symbols[at] + symbols.pop(at + 1)
            symbols[at] = own(joined, joined)
            del joint[at]
            if at:
                joint[at - 1] = find(symbols[at - 1] + symbols[at], _NEVER)
            if at < len(joint):
                joint[at] = find(symbols[at] + symbols[at + 1], _NEVER)
            scores.append(best)
            firsts.append(symbols[0])
            lasts.append(symbols[-1])
        known = (*scores, _NEVER), tuple(firsts), tuple(lasts)
        if piece in self.names:  # so there are no more than pieces
            self.traces[piece] = known if len(symbols) == 1 else None
        return known if len(symbols) == 1 else None

    def apart(self, left: str, right: str) -> bool:
        """Whether merging the characters of both leaves exactly these two (of an empty left one, `right` alone).

        The joinings of either take place in turn, by score and the left one first at ties, unless one across their border comes before.
        """
        after = self.merges(right)
        if not left or after is None:
            return after is not None
        before = self.merges(left)
        if before is None:
            return False
        (mine, _, lasts), (theirs, firsts, _), find, i, j = before, after, self.scores.get, 0, 0
        while True:
            x, y, across = mine[i], theirs[j], find(lasts[i] + firsts[j], _NEVER)
            if across > x and across >= y:
                return False
            if x < y:
                j += 1
            elif x == _NEVER:
                return True
            else:
                i += 1

    def fit(self, pair: int, left: str, right: str) -> bool:
        """`apart`, noted under the number of the pair."""
        known = self.fits.get(pair)
        if known is None:
            if self.fits_bytes > REMEMBERED:
                self.fits.clear()
                self.fits_bytes = 0
            known = self.fits[pair] = self.apart(left, right)
            self.fits_bytes += FIT_BYTES
        return known

    def split(self, part: str) -> list[int]:
        """The pieces of a part by backtracking, as ids; a character without one is its code point and `_CHARACTER`."""
        n, ids, known = len(part), self.ids.get, self.fits.get
        # Where the longest piece from each place ends: matches come by their ends.
        longest = [*range(1, n + 1)]
        for last, back in self.automaton.iter(part):
            longest[last - back] = last + 1
        failed, at, before, row, starts, found = 0, 0, "", _NOTHING * _PAIRS, [], []
        while at < n:
            end = longest[at]
            # Shorter ones are looked up, since the longest mostly fits. A place gone back to starts over: what failed from it is noted.
            while end > at:
                if not failed >> end & 1:
                    piece = part[at:end]
                    own = ids(piece)
                    if own is None and end == at + 1:
                        own = _CHARACTER + ord(piece)
                    if own is not None:
                        fits = known(row + own)
                        if self.fit(row + own, before, piece) if fits is None else fits:
                            starts.append(at)
                            found.append(own)
                            before, row, at = piece, own * _PAIRS, end
                            break
                end -= 1
            else:
                failed |= 1 << at
                at = starts.pop()
                found.pop()
                before, row = (part[starts[-1] : at], found[-1] * _PAIRS) if found else ("", _NOTHING * _PAIRS)
        return found

    def _without_piece(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode()] if self.has_bytes else [self.unknown]

    def encode_part(self, part: str) -> bytes:
        known = self.parts.get(part)
        if known is None:
            if self.parts_bytes > REMEMBERED:
                self.parts.clear()
                self.parts_bytes = 0
            ids = self.split(part)
            if max(ids, default=0) >= _CHARACTER:
                ids = [i for own in ids for i in ((own,) if own < _CHARACTER else self._without_piece(chr(own - _CHARACTER)))]
            known = array("i", ids).tobytes()
            if len(part) <= REMEMBERED_LENGTH:
                self.parts[part] = known
                self.parts_bytes += ENTRY_BYTES + 5 * len(part)
        return known

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a stretch of escaped text, as bytes; it is cut where no piece reaches across."""
        known = self.parts.get(chunk)
        if known is not None:
            return known
        if chunk[1:].isalpha():
            return self.encode_part(chunk)
        pairs, parts = self.pairs, []
        for unit in _UNITS.findall(chunk):
            if parts and parts[-1][-1] + unit[0] in pairs:
                parts[-1] += unit
            else:
                parts.append(unit)
        return self.encode_part(parts[0]) if len(parts) == 1 else b"".join(map(self.encode_part, parts))

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids start (one more entry at the end)."""
        texts = texts.fill_null("").cast(pa.string())
        words, firsts = chunks_of(texts)
        coded = words.dictionary_encode()
        each = [self.encode_chunk(SPACE + w) for w in coded.dictionary.to_pylist()]
        counts = np.fromiter(map(len, each), np.int64, len(each)) >> 2
        flat = np.frombuffer(b"".join(each), np.int32)
        index = coded.indices.to_numpy(zero_copy_only=False)
        ids = take_ranges(flat, (np.cumsum(counts) - counts)[index], counts[index])
        ends = np.concatenate([[0], np.cumsum(counts[index])])
        return ids, ends[firsts]

    def decode_ids(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """Texts of id sequences; the space put before a text is taken off again."""
        texts, at, starts = [], 0, np.asarray(starts, np.int64)
        while at < len(starts) - 1:
            end = max(at + 1, int(np.searchsorted(starts, starts[at] + DECODED_AT_ONCE, side="right")) - 1)
            own = ids[starts[at] : starts[end]]
            counts = self.surface_lengths[own]
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)[starts[at : end + 1] - starts[at]].tolist()
            raw = take_ranges(self.surface_bytes, self.surface_starts[own], counts).tobytes()
            texts += [raw[a + (raw[a : a + 1] == b" ") if a < b else a : b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
            at = end
        return texts


_NEVER = float("-inf")
#: Ids are below the first; characters without one follow it, and a number for no piece at all. A pair of them is one number:
#: the left one times a larger odd one, whose low bits a dict finds spread, and the right one.
_CHARACTER, _NOTHING, _PAIRS = 1 << 20, (1 << 20) + 0x110000, (1 << 22) + 1
_UNITS = re.compile(r"▁*[^\W\d_]+|.", re.DOTALL)
_ODD = f"  |{SPACE}|^ "
_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")


def chunks_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Stretches of each text, without the space they start with, and each text's first stretch.

    A stretch is a run of spaces and what follows up to the next space. Texts without doubled or
    leading spaces are split by Arrow, the others one by one.
    """
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, " ").cast(pa.list_(pa.string()))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    if not odd.any() and not empty.any():
        return lists.flatten(), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    rows = []
    for k in np.flatnonzero(odd | empty):
        text = texts[int(k)].as_py()
        escaped = SPACE + text.replace(" ", SPACE)
        rows.append((int(k), [x[1:] for x in _RUNS.findall(escaped)] if text else []))
    flat, ends, parts, done = lists.flatten(), np.concatenate([[0], np.cumsum(counts)]), [], 0
    for k, own in rows:
        parts += [flat.slice(ends[done], ends[k] - ends[done]), pa.array(own, pa.string())]
        counts[k], done = len(own), k + 1
    parts.append(flat.slice(ends[done]))
    return pa.concat_arrays(parts), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


@lru_cache(maxsize=2)
def model_at(path: str) -> PieceModel:
    return PieceModel(path)


@lean
def _encode(batches: Iterator[pa.RecordBatch], path: str, decode: bool) -> Iterator[pa.RecordBatch]:
    model = model_at(path)
    for batch in (part for whole in batches for part in slices(whole, 1, SLICE)):
        ids, starts = model.encode_texts(batch.column(1))
        columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))]
        if decode:
            columns.append(pa.array(model.decode_ids(ids, starts), pa.string()))
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])


@lean
def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = model_at(path)
    for batch in batches:
        starts = batch.column(1).offsets.to_numpy().astype(np.int64)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(starts, starts[at] + SLICE // 2, side="right")) - 1)
            own = batch.slice(at, end - at)
            ids = own.column(1).flatten().to_numpy(zero_copy_only=False)
            texts = model.decode_ids(ids, starts[at : end + 1] - starts[at])
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])
            at = end


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, without begin or end ids; with `decode` also `decoded`, the text of these ids.

    A null or empty text has no ids. Ids of documents are passed on unchanged, repeated or null ones
    too; further columns are ignored. The model file must be readable at the same path on every machine.
    """
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return texts.mapInArrow(partial(_encode, path=model_path, decode=decode), T.StructType(fields[: 2 + decode]))


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """Adds `decoded`, the text of each row's ids, to doc_id and ids; null ids count as empty."""
    schema = T.StructType([encoded.schema["doc_id"], encoded.schema["ids"], T.StructField("decoded", T.StringType())])
    some = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return some.mapInArrow(partial(_decode, path=model_path), schema)
