"""Alignment, repeated strings and vector codes against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from oreflow.llm import suffix_order, vector_codes
from oreflow.llm.alignment import _surface_of_bytes, align_tokens, groups_of
from oreflow.llm.queries import alignment, suffix_order as suffix_query, vector_codes as codes_query
from oreflow.llm.suffix_dedup import remove_repeated_strings
from oreflow.llm.vector_codes import again, encode_vectors, nearest

FOLDER = "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [
    None, "", " ", "  ", "   a", "a  b   c ", "x\n y", "x \n y", "a b  c", "▁x y", "a <|endoftext|> b", "<s> hi </s> <0x41>", "日本語のテキスト " * 50,
    "x" * 20_000, "tab\t\tb \t c", "　 a", "é " + "😀" * 30, "it's  don't 'll 12345 a1b2 \r\n\r\n  ok", "a \x1c b", "end ", "   x", "\x00 y \x00", "a b c d", "a b c d",
]


def aligned_by_hand(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a_model.encode_special_tokens = True
    stands = _surface_of_bytes()
    piece = lambda i: bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], Counter()
    for text in texts:
        if not text:
            found.append(None)
            continue
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        a_bytes, b_bytes = [bytes(stands[c] for c in a_model.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            found.append(None)
            continue
        a_owner = [k for k, x in enumerate(a_bytes) for _ in x]
        b_owner = [k for k, x in enumerate(b_bytes) for _ in x]
        links = sorted(set(zip(a_owner, b_owner, strict=True)))
        groups, since = [], (0, 0)
        for at in range(len(a_owner)):
            if at + 1 == len(a_owner) or (a_owner[at + 1] > a_owner[at] and b_owner[at + 1] > b_owner[at]):
                until = a_owner[at] + 1, b_owner[at] + 1
                groups.append((a[since[0] : until[0]], b[since[1] : until[1]]))
                since = until
        links = [(a[x], b[y]) for x, y in links]
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    rows = []
    for x in found:
        if x is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = x
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        rows.append((n_a, n_b, len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return rows


def test_alignment_of_odd_and_given_texts(spark):
    given = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    texts = ODD_TEXTS + given
    ids = [None if k == 3 else k // 2 for k in range(len(texts))]
    frame = spark.createDataFrame(list(zip(ids, texts, ["own"] * len(ids), strict=True)), "doc_id long, text string, slice string").repartition(5)
    got = sorted((tuple(r) for r in align_tokens(frame, BYTES, PIECES).collect()), key=str)
    assert got == sorted(((i, *r) for i, r in zip(ids, aligned_by_hand(texts), strict=True)), key=str)


def test_alignment_of_an_empty_table_and_of_text_ids(spark):
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string"), BYTES, PIECES).count() == 0
    one = align_tokens(spark.createDataFrame([("k", "a word")], "doc_id string, text string"), BYTES, PIECES).first()
    assert (one.doc_id, one.n_links, one.n_best, one.count_sum) == ("k", one.n_a + one.n_b - one.n_groups, one.n_links, one.n_links)


def test_pointer_jumping_cuts_where_both_rows_of_tokens_end():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, int(rng.integers(0, n + 1))), n)) for _ in range(2))
        cuts = np.intersect1d(a, b)
        of_a, of_b = groups_of(a, b)
        assert of_a.tolist() == np.searchsorted(cuts, a).tolist()
        assert of_b.tolist() == np.searchsorted(cuts, b).tolist()


@pytest.mark.parametrize("blind", [2, 5, 48])
def test_suffix_order(blind, monkeypatch):
    monkeypatch.setattr(suffix_order, "BLIND", blind)
    rng = np.random.default_rng(blind)
    for _ in range(60):
        length = int(rng.choice([8, 20, 64, 70, 100, 400]))
        base = rng.integers(0, int(rng.choice([2, 4, 256])), int(rng.integers(length, 3 * length + 50))).astype(np.uint8)
        parts = [base.copy() for _ in range(int(rng.integers(1, 12)))]
        for part in parts:
            part[rng.integers(0, len(part), int(rng.integers(0, 3)))] = rng.integers(0, 256)
        data = np.concatenate(parts)
        starts = np.flatnonzero(rng.random(len(data) - length + 1) < 0.7)
        order, equal = suffix_order.ordered(data, starts, length, int(rng.choice([8, 16, 64])))
        texts = [data[s : s + length].tobytes() for s in starts[order].tolist()]
        assert sorted(order.tolist()) == list(range(len(starts)))
        assert texts == sorted(texts)
        assert equal.tolist() == [False][: len(texts)] + [a == b for a, b in zip(texts, texts[1:], strict=False)]


def strings_by_hand(rows, length):
    counts = Counter()
    coded = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in coded:
        counts.update(raw[k : k + length] for k in range(len(raw) - length + 1))
    out = []
    for i, raw in coded:
        gone = np.zeros(len(raw) + 2, bool)
        for k in range(len(raw) - length + 1):
            if counts[raw[k : k + length]] > 1:
                gone[k + 1 : k + 1 + length] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[1:-1]])
        out.append((i, len(raw), int(gone.sum()), len(edges) // 2, edges.tolist(), kept))
    return sorted(out, key=str)


def strings_found(spark, rows, length, **settings):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, numbers string").repartition(5)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.spans, bytes(r.kept)) for r in remove_repeated_strings(frame, length, **settings).collect()), key=str)


def made_rows(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé ") for _ in range(300)) for _ in range(4)]

    def variant():
        text = ""
        for _ in range(rng.randint(0, 4)):
            letters = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                letters[rng.randrange(len(letters))] = rng.choice("xyz")
            at = rng.randrange(len(letters))
            text += "".join(letters[at:] + letters[:at]) if rng.random() < 0.5 else "".join(letters)
        return text

    rows = [(i, variant()) for i in range(100)]
    return [*rows, *rows[3:6], (5, variant()), (5, base[0] * 2), (None, base[1]), (None, None), (7, ""), (8, "a" * 900), (9, "ab" * 300)]


@pytest.mark.parametrize(("length", "settings"), [(40, {}), (40, {"group": 8}), (100, {"group": 4}), (400, {})])
def test_repeated_strings_of_made_texts(spark, length, settings):
    rows = made_rows(length)
    assert strings_found(spark, rows, length, **settings) == strings_by_hand(rows, length)


@pytest.mark.parametrize("group", [16, 4096])
def test_a_passage_that_very_many_texts_share(spark, group):
    """Shorter than a string, as long, and longer: each is decided, however the group is split."""
    rng = random.Random(group)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(90)
    rows = [(i, noise(60) + passage[: rng.choice([59, 60, 90])] + noise(rng.randint(0, 60))) for i in range(200)]
    assert strings_found(spark, rows, 60, group=group) == strings_by_hand(rows, 60)


def test_a_very_long_text_and_an_empty_table(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5_000_000))
    rows = [(1, text), (2, "z" * 50 + text[4_000_000:4_000_700] + "z" * 50), (3, text[10:400])]
    assert [(r[0], r[2], r[4]) for r in strings_found(spark, rows, 400)] == [(1, 700, [4_000_000, 4_000_700]), (2, 700, [50, 750]), (3, 0, [])]
    assert remove_repeated_strings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def codes_by_hand(rows, parts=16, entries=64, rounds=2):
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    whole = [[math.floor(256 * x) for x in r[2]] for r in kept]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, whole[k]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    for step in range(rounds + 1):
        codes = [[min(range(len(books[p])), key=lambda e: (far(v[p], books[p][e]), e)) for p in range(parts)] for v in cut]
        if step == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, c in zip(cut, codes, strict=True) if c[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    errors = [sum(far(v[p], books[p][c[p]]) for p in range(parts)) for v, c in zip(cut, codes, strict=True)]
    total = Counter()
    for r, n in zip(kept, errors, strict=True):
        total[r[1]] += n
    return books, sorted(((r[0], r[1], bytes(c), n, total[r[1]]) for r, c, n in zip(kept, codes, errors, strict=True)), key=str)


@pytest.mark.parametrize(("labels", "spread"), [(10_000, 1.0), (2, 200.0)])
def test_vector_codes(spark, labels, spread, monkeypatch):
    monkeypatch.setattr(vector_codes, "LABELS", labels)
    rng = random.Random(labels)
    rows = [(k, k % 5 if k % 3 else None, [rng.choice([-0.5, 0.25, 0.251, rng.gauss(0, spread)]) for _ in range(32)]) for k in range(150)]
    rows += [rows[3], rows[3], (None, 1, rows[4][2]), (70, 9, [0.0] * 32), (200, 1, None), (1, 1, [float("nan")] * 32), (0, 0, [None, *[1.0] * 31]), (2, 2, [float("inf"), *[1.0] * 31])]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, label int, embedding array<double>, code int").repartition(4)
    made = encode_vectors(frame)
    books, expected = codes_by_hand(rows)
    assert made.books.tolist() == books
    assert sorted(((r.vec_id, r.label, bytes(r.code), r.error, r.label_error) for r in made.rows.collect()), key=str) == expected


def test_fewer_vectors_than_entries_other_lengths_and_none(spark):
    schema = "vec_id long, label int, embedding array<float>"
    few = encode_vectors(spark.createDataFrame([(1, 1, [0.5] * 16), (2, None, [1.5] * 16), (3, 1, [1.0] * 48), (4, 1, [])], schema))
    assert sorted((r.vec_id, bytes(r.code), r.error) for r in few.rows.collect()) == [(1, bytes(16), 0), (2, bytes([1] * 16), 0)]
    none = encode_vectors(spark.createDataFrame([], schema))
    assert none.rows.count() == 0
    assert none.books_sha256() == hashlib.sha256(b"").hexdigest()


def test_only_moved_entries_are_compared_and_ties_go_to_the_lower_index():
    rng = np.random.default_rng(2)
    for _ in range(100):
        x, old = rng.integers(-3, 4, (80, 2)), rng.integers(-3, 4, (12, 2))
        new = np.where(rng.random((12, 1)) < 0.3, rng.integers(-3, 4, (12, 2)), old)
        code, far = again(x, new, (new != old).any(axis=1), *nearest(x, old))
        wanted = nearest(x, new)
        assert code.tolist() == wanted[0].tolist()
        assert far.tolist() == wanted[1].tolist()


def test_query_columns(spark):
    assert alignment(spark, FOLDER).columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert suffix_query(spark, FOLDER).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert codes_query(spark, FOLDER).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
