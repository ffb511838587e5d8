"""One query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import oracles, passage_attention
from oreflow.llm.alignment import align_tokens
from oreflow.llm.contamination import find_passages
from oreflow.llm.parity_join import near_copies
from oreflow.llm.pieces import encode_pieces
from oreflow.llm.preferences import preference_rows, swapped, turns_of
from oreflow.llm.rules import judge
from oreflow.llm.secrets import find_secrets
from oreflow.llm.substrings import remove_repeats
from oreflow.llm.suffix_dedup import remove_repeated_strings
from oreflow.llm.surrogates import replace_entities
from oreflow.llm.token_files import read_token_files, write_token_files
from oreflow.llm.vector_codes import encode_vectors
from oreflow.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Key of the surrogates that the query makes; in use it is a secret of the caller.
SURROGATE_KEY = b"surrogates of the query"


def surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return replace_entities(docs, SURROGATE_KEY, count_col="n_entities")


def preferences(spark: SparkSession, folder: str) -> DataFrame:
    mask = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x.start.cast("string"), x.end.cast("string"))), ",").alias(c)
    made = preference_rows(swapped(turns_of(table(spark, folder, "conversations"))))
    return made.select("pair_id", "n_prompt_turns", "prompt", "chosen", "rejected", mask("chosen_mask"), mask("rejected_mask"), "identical")


def parity_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents"))


def rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def quality_network(spark: SparkSession, docs: DataFrame, folder: str) -> passage_attention.Network | float:
    """The network learned from the documents and their labels, those that are held out left out."""
    labels = table(spark, folder, "labels").where(~passage_attention.held_out()).select("doc_id", F.col("quality").alias("label"))
    return passage_attention.fit(docs, labels)


def kept_by_score(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents, all columns and rows as they are, without those scored under one half."""
    return passage_attention.keep(docs, quality_network(spark, docs, folder))


def attention(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scores = passage_attention.score(docs, quality_network(spark, docs, folder))
    return scores.select("doc_id", passage_attention.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids_le").alias("ids_crc32"))


def piece_digests(docs: DataFrame) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = encode_pieces(docs, model, decode=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    base = F.filter("spans", lambda x: x.kind != "guess")
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digests(table(spark, folder, "documents"))


def passages(spark: SparkSession, folder: str) -> DataFrame:
    found = find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate(
        F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def substrings(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def suffix_order(spark: SparkSession, folder: str) -> DataFrame:
    left = remove_repeated_strings(table(spark, folder, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_vectors(table(spark, folder, "embeddings"))
    return coded.rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(coded.books_sha256()).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_surrogates": surrogates,
        "op2_preferences": preferences,
        "op3_parity_join": parity_join,
        "op4_rules": rules,
        "op5_attention": attention,
        "op6_token_files": token_files,
        "op7_secrets": secrets,
        "op8_pieces": pieces,
        "op9_passages": passages,
        "op10_substrings": substrings,
        "op11_alignment": alignment,
        "op12_suffix_order": suffix_order,
        "op13_vector_codes": vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    """SQL where it can do the same: not for keyed surrogates, learned scores, guess costs and tokenizers."""
    return {
        "op2_preferences": oracles.PREFERENCES,
        "op3_parity_join": oracles.PARITY_JOIN,
        "op9_passages": oracles.PASSAGES,
        "op10_substrings": oracles.SUBSTRINGS,
        "op12_suffix_order": oracles.SUFFIX_ORDER,
        "op13_vector_codes": oracles.VECTOR_CODES,
    }
