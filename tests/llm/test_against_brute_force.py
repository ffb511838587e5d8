"""Joins, windows and rules against plain versions on small made-up tables."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from oreflow.llm.contamination import _blocks, find_passages, remove_passages
from oreflow.llm.fm_index import FMIndex, suffix_array
from oreflow.llm.parity_join import BANDS, Sets, _once, near_copies
from oreflow.llm.rules import RULES, START, fit, judge, votes
from oreflow.llm.substrings import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- near copies


def shingles(text):
    w = WORD.findall(low(text))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def alike(rows):
    sets = {i: shingles(t) for i, t in rows}
    part = {i: i for i in sets}

    def top(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                part[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def made(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    passage, base = ([rng.choice(words) for _ in range(k)] for k in (60, 120))
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3:
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = rng.choice(words)
        elif kind < 0.6:
            own = [rng.choice(words) for _ in range(rng.randint(5, 80))]
            w = own[: len(own) // 2] + passage + own[len(own) // 2 :]
        elif kind < 0.8:
            w = [rng.choice(words[:3]) for _ in range(rng.randint(0, 12))]
        else:
            w = rng.choice(rows)[1].split() if rows else ["a"]
            if w:
                w[rng.randrange(len(w))] = "X"
                w = w[: max(1, len(w) - rng.randint(0, 9))]
        rows.append((i, " ".join(w)))
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \t ")]


@pytest.mark.parametrize("group", [2, 16])
def test_near_copies(spark, group):  # 2: nearly all groups count as large
    rows = made(3, 120)
    got = near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), group=group)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == alike(rows)


def test_large_groups_of_the_same_documents_stay_for_each_parity(spark):
    # Keys 2, 4 and 7 have the same nodes; 9 is one component already.
    rows = [(key, node, key & 1, node % 2) for key in (2, 4, 7) for node in range(18)] + [(9, node, 1, 5) for node in range(18)]
    got = _once(spark.createDataFrame(rows, "key long, node long, parity int, part long"))
    assert sorted(map(tuple, got.collect())) == [(2, 18), (7, 18)]


def test_near_copies_of_short_families(spark):  # templates of 5 to 10 shingles, over 16 variants each
    rng, rows = random.Random(8), []
    for f in range(12):
        base = [f"f{f}x{k}" for k in range(rng.randint(9, 14))]
        for _ in range(24):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.choice([0, len(w) - 1])] = f"f{f}y{rng.randrange(5)}"
            rows.append(" ".join(w[rng.randint(0, 1) :]))
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    got = near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == alike(rows)


def test_weak_documents_meet_by_prefix_at_the_level_of_the_pair():
    texts = [" ".join(f"{f}w{k}" for k in range(n)) for f in range(2000) for n in (7, 8, 9)]
    sets = Sets(pa.array(texts))
    level = np.searchsorted(BANDS, sets.sizes, side="right") - 1
    keys = {}
    for lower in (0, 1):
        weak = sets.sketches(lower)[3] <= 0
        for key, row in zip(*(x.tolist() for x in sets.prefixes(weak, lower)), strict=True):
            assert key & 1 == (level[row] - lower) & 1
            keys.setdefault((row, int(level[row]) - lower), set()).add(key)
    met = 0
    for a in range(len(texts)):
        for b in range(a // 3 * 3, a):
            at, own, other = int(min(level[a], level[b])), shingles(texts[a]), shingles(texts[b])
            if (a, at) in keys and (b, at) in keys and 100 * len(own & other) >= 75 * len(own | other):
                assert keys[a, at] & keys[b, at]
                met += 1
    assert met > 10


def test_near_copies_of_odd_tables(spark):
    schema = "doc_id long, text string, component_id string, a int"
    assert near_copies(spark.createDataFrame([], schema)).count() == 0
    rows = [(2, "a b c d e f", "x", 1), (2, "a b c d e f", "x", 1), (None, "a b c d e f", "x", 1), (1, "A b c d e f", "x", 1), (3, None, "x", 1)]
    got = sorted(map(tuple, near_copies(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(2, 2, 1), (2, 2, 1), (None, 2, None), (1, 2, 1), (3, 0, 3)], key=str)


# ---- substrings


def test_repeats(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    shared = [[rng.choice(words) for _ in range(rng.randint(4, 20))] for _ in range(4)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += rng.choice(shared) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 9))]
        rows.append((i * 7 % 61, " ".join(w) + " "))
    rows += [(100, None), (101, ""), (102, "same " * 30), (103, "same " * 30)]
    first, width = {}, 5
    cut = {i: WORD.findall(t or "") for i, t in rows}
    for i in sorted(cut):
        for k in range(len(cut[i]) - width + 1):
            first.setdefault(tuple(cut[i][k : k + width]), i)
    expected = {}
    for i, w in cut.items():
        gone = {k + j for k in range(len(w) - width + 1) if first[tuple(w[k : k + width])] < i for j in range(width)}
        expected[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), width)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got.collect()} == expected


def test_repeats_of_odd_tables(spark):
    schema = "doc_id long, text string, places string"
    assert remove_repeats(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, "a b c", "x"), (2, "z a b c", "x")]
    got = sorted((str(r.doc_id), r.n_removed) for r in remove_repeats(spark.createDataFrame(rows, schema), 3).collect())
    assert got == [("1", 0), ("1", 0), ("2", 3), ("None", 0)]


# ---- passages


def test_index():
    import numpy as np

    rng = np.random.default_rng(0)
    for t in range(60):
        s = np.append(rng.integers(0, rng.integers(2, 5), rng.integers(1, 120)), 0)
        s = np.tile(s, 3) if t % 3 == 0 else s

        def key(i, s=s):
            out = []
            while s[i]:
                out.append((1, int(s[i])))
                i += 1
            return [*out, (0, i)]

        assert suffix_array(s.astype(np.int32)).tolist() == sorted(range(len(s)), key=key)
        index = FMIndex(s.astype(np.int32), 6)
        runs = np.array([s[i : i + 3] for i in range(len(s) - 2) if (s[i : i + 3] > 0).all()]).reshape(-1, 3)
        for run, a, b in zip(runs, *index.ranges(runs), strict=True):
            assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(len(s) - 2) if (s[i : i + 3] == run).all()]


def passages(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = PLAIN.findall(low(text))
        for x in [tuple(w[k : k + width]) for k in range(len(w) - width + 1)] or ([tuple(w)] if w else []):
            windows.setdefault(x, set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = PLAIN.findall(low(text)), set(), set()
        for x, own in windows.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit |= set(range(k, k + len(x)))
                    found |= own
        out[doc] = (len(w), len(hit), sorted(i for i in found if i is not None))
    return out


def passage_tables():
    rng = random.Random(4)
    words = "Aa bb cc Éé 12 dd".split()
    items = [(f"i{k}", "-".join(rng.choice(words) for _ in range(rng.randint(1, 16)))) for k in range(8)]
    items += [("none", None), ("empty", " . "), (None, "ee ff gg"), ("i0", "ee ff hh ii jj kk ll mm nn oo pp")]
    docs = []
    for k in range(40):
        w = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.7:
            w.insert(rng.randint(0, len(w)), rng.choice(items)[1] or "x")
        docs.append((k, ", ".join(w)))
    return [*docs, (90, None), (91, ""), (92, "the ee FF gg")], items


@pytest.mark.parametrize("block", [1 << 22, 250])
def test_passages(spark, monkeypatch, block):
    monkeypatch.setattr("oreflow.llm.contamination.BLOCK_BYTES", block)
    docs, items = passage_tables()
    schema = "doc_id long, text string"
    got = find_passages(spark.createDataFrame(docs, schema).repartition(2), spark.createDataFrame(items, "item_id string, text string"))
    assert {r.doc_id: (r.n_words, sum(r.spans[1::2]) - sum(r.spans[::2]), r["items"]) for r in got.collect()} == passages(docs, items)


def test_repeated_items_count_once(spark, monkeypatch):
    monkeypatch.setattr("oreflow.llm.contamination.BLOCK_BYTES", 20)
    rows = [("a", "one two three")] * 9 + [("b", "four five six"), ("a", "seven eight")]
    blocks = list(_blocks(spark.createDataFrame(rows, "item_id string, text string")))
    assert sorted(x for block in blocks for x in block) == sorted(set(rows)) and max(map(len, blocks)) == 1


def test_passages_of_several_blocks_go(spark, monkeypatch):
    monkeypatch.setattr("oreflow.llm.contamination.BLOCK_BYTES", 10)
    docs = spark.createDataFrame([(1, "keep a b c d and e f g h c d e f"), (1, None), (2, "clean"), (None, "d e f g h")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "a b c d"), ("r", "e f g h"), ("s", "d e f")], "item_id string, text string")
    got = sorted((str(r.doc_id), str(r.text).split()) for r in remove_passages(docs, items, width=3).collect())
    assert got == [("1", ["None"]), ("1", ["keep", "and", "c"]), ("2", ["clean"]), ("None", [])]


def test_passages_go(spark):
    schema = "doc_id long, text string, spans int, items string"
    docs = spark.createDataFrame([(1, "Keep this. A b c d! And that", 1, "x"), (1, None, 1, "x"), (None, "a B c, d", 1, "x"), (2, "clean", 1, "x")], schema)
    items = spark.createDataFrame([("q", "a b c d")], "item_id string, text string")
    out = remove_passages(docs, items)
    assert out.schema == docs.schema
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == [("1", "Keep this. ! And that"), ("1", "None"), ("2", "clean"), ("None", "")]
    assert remove_passages(docs.limit(0), items).count() == 0
    assert remove_passages(docs, items.limit(0)).collect() == docs.collect()


# ---- rules


def test_counts(spark):
    rng = random.Random(6)
    rows = [(k, "".join(rng.choice(["a ", "b ", "Cc ", "\n", "é# ", "\t", "x.", "  "]) for _ in range(rng.randint(0, 80)))) for k in range(80)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "one two"), (104, "w " * 5000)]
    got = {r.doc_id: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, text in rows:
        text = text or ""
        w = WORD.findall(text)
        windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        )
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_estimates(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(4000):
        good = rng.random() < 0.9
        rows.append(tuple((1 if rng.random() < (0.98 if good else 0.2) else -1) if rng.random() < 0.8 else 0 for _ in RULES))
    model = fit(spark.createDataFrame(rows, ", ".join(f"{r} int" for r in RULES)))
    assert abs(model.good_share - 0.9) < 0.02
    assert all(abs(x - 0.98) < 0.02 for x in model.vote_good_if_good) and all(abs(x - 0.2) < 0.1 for x in model.vote_good_if_bad)


def test_no_documents_to_judge(spark):
    schema = "doc_id long, text string, symbols string, kept int"
    empty = spark.createDataFrame([], schema)
    assert judge(empty).count() == 0
    assert judge(spark.createDataFrame([(None, None, "x", 1), (None, None, "x", 1)], schema)).where("kept").count() == 0
    assert len(votes()) == len(RULES)
    assert fit(spark.createDataFrame([], ", ".join(f"{r} int" for r in RULES))) == START
