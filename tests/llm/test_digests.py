"""Token files and piece encoding against the libraries."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")

from oreflow.llm import pieces, queries  # noqa: E402
from oreflow.llm.pieces import PieceModel, decode_pieces, encode_pieces  # noqa: E402
from oreflow.llm.token_files import CachedTokenizer, pack_ids, read_token_files, unpack_ids, write_token_files  # noqa: E402

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", " a", "a ", "   a  b   ", "▁", "<s>", "<0x41>", "<unk>", "a\x00b", "\x00", "1234567", "日本語", "\U0001f600" * 5,
    "\n\n\n  \t x", "▁" * 20 + " a", "a" * 60, "ﬁ ß", "<|endoftext|> x <|endoftext|>", ".com", "it's", "a \n b", "x　y  z",
]


def texts():
    rng = random.Random(1)
    alphabet = "ab  ▁\n\tthe ing 12.9éß中\U0001f600<s> 　,.!"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    made += ["".join(rng.choice("theingaoru ") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    return ODD + made


def test_pieces_are_apart_where_merging_all_characters_leaves_them():
    model = PieceModel(PIECES)

    def merged(text: str) -> list[str]:
        symbols = list(text)
        while True:
            scores = [model.scores.get(a + b, float("-inf")) for a, b in zip(symbols, symbols[1:], strict=False)]
            if not scores or max(scores) == float("-inf"):
                return symbols
            k = scores.index(max(scores))
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]

    draw = random.Random(8)
    pool = [*draw.sample(sorted(model.ids), 400), "a", "aa", "aaa", "\u2581", "\u2581a", "the", "\u2581the", "e", "r", "er", "\U0001f995", "zzzzq", "st", "ss", "s"]
    found = set()
    for left in [*draw.sample(pool, 120), *pool[400:], ""]:
        for right in pool:
            expected = merged(left + right) == ([left, right] if left else [right])
            assert model.apart(left, right) == expected, (left, right)
            found.add(expected)
    assert found == {True, False}
    assert set(model.traces) <= set(model.ids)  # known once for each piece, not for each pair


def test_a_split_yields_ids_and_notes_fits_by_the_numbers_of_both_pieces():
    model, library = PieceModel(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    names = {i: p for p, i in model.ids.items()}

    def named(own: int) -> str:
        return names[own] if own in names else "" if own == pieces._NOTHING else chr(own - pieces._CHARACTER)

    for text in texts():
        found = model.split(text.replace(" ", "▁"))
        assert "".join(map(named, found)) == text.replace(" ", "▁")
    for word in ("thonreing", "Gegeenpfä", "x🦕y", "zzzzq"):
        ids, starts = model.encode_texts(pa.array([word]))
        assert ids.tolist() == library.encode(word)
    assert len(model.fits) > 500 and all(isinstance(pair, int) for pair in model.fits)
    for pair, known in list(model.fits.items())[:500]:
        assert known == model.apart(named(pair // pieces._PAIRS), named(pair % pieces._PAIRS))


def test_decoding_holds_little_beside_its_texts():
    model = PieceModel(PIECES)
    ids, starts = model.encode_texts(pa.array(["the quick brown fox jumps over the lazy dog, again and again "] * 50_000))
    tracemalloc.start()
    texts = model.decode_ids(ids, starts)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(texts) == {"the quick brown fox jumps over the lazy dog, again and again "}
    assert held < 20 * sum(map(len, texts)), held


def test_pieces_equal_the_library():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), PieceModel(PIECES)
    ids, starts = own.encode_texts(pa.array(texts()))
    decoded = own.decode_ids(ids, starts)
    for k, text in enumerate(texts()):
        expected = library.encode(text)
        assert ids[starts[k] : starts[k + 1]].tolist() == expected, text
        assert decoded[k] == library.decode(expected)


def test_backtracking_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr("oreflow.llm.pieces.REMEMBERED", 3)
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), PieceModel(PIECES)
    ids, starts = own.encode_texts(pa.array(texts()))
    assert all(ids[starts[k] : starts[k + 1]].tolist() == library.encode(t) for k, t in enumerate(texts()))


def test_tokens_equal_the_library():
    library, own = tokenizers.Tokenizer.from_file(BYTES), CachedTokenizer(BYTES)
    ids, starts = own.encode(pa.array(texts()))
    for k, text in enumerate(texts()):
        assert ids[starts[k] : starts[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000, 40_000])
@pytest.mark.parametrize("most", [1, 300, 50_000, 2**32])
def test_blocks_come_back(n, most):
    ids = np.random.default_rng(n).integers(0, most, n, dtype=np.uint64).astype(np.uint32)
    ids[::37] = 2**32 - 1
    packed = pack_ids(ids)
    assert (unpack_ids(packed) == ids).all()
    assert (unpack_ids(packed, n // 3, 200) == ids[n // 3 : n // 3 + 200]).all()


ROWS = [(5, "b c", "x"), (1, None, "x"), (3, "", "x"), (2, "The cat. " * 400, "x"), (2, "again", "x"), (None, "no id", "x"), (9, " lead", "x")]
SCHEMA = "doc_id long, text string, ids string"  # a column named as an output


def test_token_files(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    write_token_files(docs, str(tmp_path / "ids"), BYTES, segment_ids=8)
    got = read_token_files(spark, str(tmp_path / "ids")).select("doc_id", "start", "n_tokens", F.crc32("ids_le").alias("crc")).collect()
    library, start, expected = tokenizers.Tokenizer.from_file(BYTES), 0, []
    for doc, text, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    write_token_files(docs, str(tmp_path / "none"), BYTES)
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0
    assert encode_pieces(docs, PIECES).count() == 0


def test_piece_frames(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    both = decode_pieces(encode_pieces(docs, PIECES), PIECES).collect()
    assert sorted((r.ids, r.decoded) for r in both) == sorted((library.encode(t or ""), library.decode(library.encode(t or ""))) for _, t, _ in ROWS)
    digests = {(r.doc_id, r.ids_sha256, r.n_tokens, r.decoded_sha256) for r in queries.piece_digests(docs).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert digests == {(d, sha(",".join(map(str, library.encode(t or "")))), len(library.encode(t or "")), sha(library.decode(library.encode(t or "")))) for d, t, _ in ROWS}
