"""Secrets in texts: fixed patterns, and values in a credential context that are costly to guess.

How costly is found by dynamic programming over a value: the cheapest way to cut it into common or
surrounding words, dates, repeats, keyboard walks and stretches tried out by brute force. A value
of words and years is cheap; random characters are not, of whatever class. Common words are the whole
words of two public vocabularies, in their order.
"""

from __future__ import annotations

import functools
import json
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.batches import slices

ASSIGN = re.compile(r"""(?P<key>(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Names after which a value is looked at, whatever its characters.
CONTEXT = re.compile(
    r"""(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|private[_-]?key|access[_-]?key|client[_-]?secret|auth)["']?[\x20\t]*(?::|=>|=)[\x20\t]*["']?([^\s"'`<>,;(){}\[\]]{6,})""",
    re.ASCII,
)
#: Texts without any of these have no spans.
_ANY = r"(?i:pass|pwd|secret|token|credential|api_?key|api-key|private[_-]?key|access[_-]?key|auth)|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"
KINDS = ("assign", "access", "hex", "guess")
#: Common logarithm of the guesses from which a value is taken for a secret.
GUESSES = 7.4
#: Words tried first by anyone who guesses, most common first.
COMMON = (
    "password", "admin", "welcome", "letmein", "login", "master", "dragon", "monkey", "secret", "test",
    "changeme", "default", "guest", "root", "user", "hello", "sunshine", "princess", "football", "shadow",
    "example", "sample", "your", "insert", "here", "token", "key", "none", "null", "true", "false",
    "required", "optional", "hidden", "redacted", "placeholder", "summer", "winter", "spring", "autumn",
)
#: Rows of keys, and the order of letters and digits.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0123456789", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol0p")
#: Characters that stand for letters.
LOOKALIKES = str.maketrans("4@301!5$7", "aaeoiisst")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0\d|1[0-2])[-/.]?[0-3]\d)?|[0-3]?\d[-/.][01]?\d[-/.](?:19|20)?\d\d")
_LETTERS = re.compile(r"[^\W\d_]{3,}")
#: Longest unit of a repeat.
_UNIT = 8
_REPEAT = re.compile(r"(.)\1\1|(.{2,8}?)\2", re.DOTALL)
#: Each further piece doubles the ways to cut.
_FRESH = math.log10(2)
_RANKS = {w: k + 1 for k, w in enumerate(COMMON)}
_STEPS = frozenset(x for row in ROWS for a, b in zip(row, row[1:], strict=False) for x in (a + b, b + a))


@functools.cache
def _vocabulary() -> dict[str, int]:
    """Words of three letters or more by rank, most common first; the files must be at the same path on every machine."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        coded = json.load(file)["model"]["vocab"]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    first = [t[1:] for t, _ in sorted(coded.items(), key=lambda x: x[1]) if t[0] == "\u0120"]
    second = [t[1:] for t in map(model.id_to_piece, range(model.get_piece_size())) if t[0] == "\u2581"]
    ranks: dict[str, int] = {}
    for words in ([w for w in first if w.isascii()], second):
        own = (w.lower() for w in words if len(w) >= 3 and w.isalpha())
        for k, w in enumerate(dict.fromkeys(own)):
            ranks[w] = min(ranks.get(w, 1 << 30), len(COMMON) + k + 1)
    return ranks


@functools.cache
def _ranks() -> dict[str, int]:
    return _vocabulary() | _RANKS


def _rank(low: str) -> int | None:
    return _ranks().get(low)


class Nearby:
    """Words of a text of three letters or more, without those of one of its values."""

    def __init__(self, counts: Counter[str]):
        common, heads = _word_forms()
        self.counts, self.own = counts, Counter()
        #: Lengths and first three letters of all words there are, the vocabularies' too.
        self.lengths = sorted(common | set(map(len, counts)))
        self.heads = heads | {w[:3] for w in counts} if counts else heads

    def without(self, value: str) -> Nearby:
        other = copy(self)
        other.own = _words(value)
        return other

    def __contains__(self, word: str) -> bool:
        return self.counts[word] > self.own[word]


def _words(text: str) -> Counter[str]:
    return Counter(w.lower() for w in _LETTERS.findall(text))


@functools.cache
def _word_forms() -> tuple[frozenset[int], frozenset[str]]:
    words = (*_vocabulary(), *COMMON)
    return frozenset(map(len, words)), frozenset(w[:3] for w in words)


def _word_cost(part: str, near: Nearby) -> float | None:
    low = part.lower()
    rank, extra = _rank(low), 0.0
    if rank is None:
        rank = _rank(low.translate(LOOKALIKES))
        extra = math.log10(2) * 2
    if len(low) >= 3 and low in near and (rank is None or rank > 2000):
        rank, extra = 2000, 0.0
    if rank is None:
        return None
    if part not in (low, low.capitalize()):
        extra += math.log10(2) * min(len(part), 6)
    elif part != low:
        extra += math.log10(2)
    return math.log10(rank + 1) + extra


def _date_cost(part: str) -> float | None:
    return None if _DATE.fullmatch(part) is None else math.log10(365 * 120) if len(part) > 4 else math.log10(120)


def _walk_cost(length: int) -> float:
    return math.log10(50 * length)


class _Growing:
    """Starts in one run of pieces whose cost grows with the logarithm of their length.

    Against an earlier start of the run, a later one gains most at its shortest piece; if it does not pay
    there, it never does, and its pieces need not be looked at.
    """

    def __init__(self) -> None:
        self.kept: list[tuple[int, float]] = []

    def pays(self, start: int, best: float, unit: int, shortest: int) -> bool:
        if any(best - b >= math.log10(((start - s) // unit + shortest) / shortest) for s, b in self.kept):
            return False
        self.kept.append((start, best))
        return True


def guess_cost(value: str, near: Nearby | frozenset[str] = frozenset(), limit: float = math.inf) -> float:
    """Common logarithm of the guesses for a value, by its cheapest cut; `near`: words that an attacker has at hand.

    Pieces are: single characters tried out (1 each); words; dates; two or more repeats of up to eight
    characters, three in all; keyboard walks from three characters on. All but the first cost log10(2) more.
    It is the least over all cuts. From `limit` on the result is infinite, and the rest of the
    value is not read: costs only grow, so nothing behind the last place in reach can be cheaper.
    """
    near = near if isinstance(near, Nearby) else Nearby(Counter(near))
    n = len(value)
    low = value.lower() if value.isascii() else [c.lower() for c in value]
    likes = low.translate(LOOKALIKES) if value.isascii() else ""
    most_units = min(_UNIT, n // 2) if _REPEAT.search(value) else 0
    best = [0.0] + [math.inf] * n
    ranks = _ranks()
    units: dict[str, float] = {}
    runs: dict[tuple[int, int, int], _Growing] = {}
    walk_end, same_end = 0, [0] * (_UNIT + 1)
    reach = 0

    def grow(start: int, unit: int, last: int, shortest: int, most: int, cost: Callable[[int], float]) -> None:
        nonlocal reach
        run = runs.setdefault((unit, last, start % max(unit, 1)), _Growing())
        if run.pays(start, best[start], max(unit, 1), shortest):
            for k in range(shortest, most + 1):
                end, total = start + k * max(unit, 1), best[start] + cost(k) + _FRESH
                if total >= limit:
                    break
                if total < best[end]:
                    best[end] = total
                    reach = max(reach, end)

    for start in range(n):
        if start > reach:
            return math.inf
        here = best[start]
        if here >= limit:
            continue
        if here + 1 < min(best[start + 1], limit):
            best[start + 1] = here + 1
            reach = max(reach, start + 1)
        for k in near.lengths if not likes or low[start : start + 3] in near.heads or likes[start : start + 3] in near.heads else ():
            if start + k > n:
                break
            if likes and low[start : start + k] not in ranks and likes[start : start + k] not in ranks and low[start : start + k] not in near.counts:
                continue
            cost = _word_cost(value[start : start + k], near)
            if cost is not None and here + cost + _FRESH < min(best[start + k], limit):
                best[start + k] = here + cost + _FRESH
                reach = max(reach, start + k)
        if value[start].isdecimal() and start + 4 <= n:
            for k in range(4, min(10, n - start) + 1):
                cost = _date_cost(value[start : start + k])
                if cost is not None and here + cost + _FRESH < min(best[start + k], limit):
                    best[start + k] = here + cost + _FRESH
                    reach = max(reach, start + k)
        for unit in range(1, most_units + 1):
            end = max(same_end[unit], start)
            while end + unit < n and value[end] == value[end + unit]:
                end += 1
            same_end[unit] = end
            most, shortest = (end - start) // unit + 1, 3 if unit == 1 else 2
            if most >= shortest:
                text = value[start : start + unit]
                if text not in units:
                    units[text] = guess_cost(text, near)
                whole = units[text]
                grow(start, unit, end, shortest, most, lambda k, whole=whole: whole + math.log10(k))
        walk_end = max(walk_end, start + 1)
        while walk_end < n and low[walk_end - 1] + low[walk_end] in _STEPS:
            walk_end += 1
        if walk_end - start >= 3:
            grow(start, 0, walk_end, 3, walk_end - start, _walk_cost)
    return best[n]


def spans_of(text: str, guesses: float = GUESSES) -> list[tuple[str, int, int]]:
    """Spans of secrets in ascending order of start, then kind as in KINDS; ends are exclusive, places count code points.

    A value of a credential context that meets a span by pattern is not judged by cost.
    """
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    starts, ends = sorted(s for _, s, _ in found), [0]
    for _, _, end in sorted(found, key=lambda x: x[1]):
        ends.append(max(ends[-1], end))
    words = None
    for m in CONTEXT.finditer(text):
        a, b = m.span(1)
        value = text[a:b].rstrip(".:!?")
        b = a + len(value)
        if ends[bisect_left(starts, b)] > a:
            continue
        if words is None:
            words = Nearby(_words(text))
        if guess_cost(value, words.without(value), guesses) >= guesses:
            found.append(("guess", a, b))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, 1, 4 << 20)):
        texts = batch.column(1).fill_null("")
        kinds, starts, ends, edges = [], [], [], [0]
        may = pc.match_substring_regex(texts, _ANY).to_numpy(zero_copy_only=False)
        own: dict[int, list] = {int(k): spans_of(texts[int(k)].as_py()) for k in np.flatnonzero(may)}
        for k in range(len(texts)):
            for kind, start, end in own.get(k, ()):
                kinds.append(kind)
                starts.append(start)
                ends.append(end)
            edges.append(len(kinds))
        each = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["kind", "start", "end"])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), each)], names=["doc_id", "spans"])


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end) of the secrets in every whole text.

    Kinds: `assign`, `access` and `hex` by pattern, `guess` by cost. Null and empty texts have none.
    Each row stands for itself; ids are passed on as they are, repeated or null; further columns are ignored.
    Long texts are read whole, their words counted once; the time grows with their length.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("spans", T.ArrayType(SPAN))])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_find, schema)
