"""Documents to token ids: quality, near copies, benchmark passages, personal data, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow.llm import queries as corpus
from oreflow.llm.contamination import remove_passages
from oreflow.llm.parity_join import near_copies
from oreflow.llm.surrogates import replace_entities
from oreflow.session import scratch_path, scratch_scope, staged


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars as the changed texts have it, for tables that have such a column."""
    if "n_chars" not in docs.columns:
        return docs
    counted: Column = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", counted)


def reject_low_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of the tables, scores at one half or more."""
    return corpus.kept_by_score(spark, docs, folder)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id. Rows with a null id stay.

    Rows that share an id are judged one by one: of equal ones the first stays, and others keep their
    place among the documents; the first by text stands for the id, the rest come after all ids.
    """
    null = docs.where("doc_id IS NULL")
    named = docs.where("doc_id IS NOT NULL")
    again = named.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        heads = near_copies(named).where("doc_id = component_id").select("doc_id")
        return named.join(heads, "doc_id", "left_semi").unionByName(null)
    key, place = _free_name(docs, "key"), _free_name(docs, "place")
    shared = named.join(again, "doc_id", "left_semi").withColumn(place, F.row_number().over(Window.partitionBy("doc_id", "text").orderBy("doc_id")))
    shared = shared.where(F.col(place) == 1).withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
    top = named.agg(F.max("doc_id")).first()[0]
    others = F.lit(top).cast("long") + 1 + F.monotonically_increasing_id()
    shared = shared.withColumn(key, F.when(F.col(place) == 1, F.col("doc_id").cast("long")).otherwise(others)).drop(place)
    once = named.join(again, "doc_id", "left_anti").withColumn(key, F.col("doc_id").cast("long"))
    keyed = staged(once.unionByName(shared), "keyed-documents")
    heads = near_copies(keyed.select(F.col(key).alias("doc_id"), "text")).where("doc_id = component_id").select(F.col("doc_id").alias(key))
    return keyed.join(heads, key, "left_semi").drop(key).select(docs.columns).unionByName(null)


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def remove_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents without the words that benchmark items share with them."""
    return _measured(remove_passages(docs, corpus.table(spark, folder, "benchmark")))


def replace_personal(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents with surrogates for personal data."""
    return _measured(replace_entities(docs, corpus.SURROGATE_KEY))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Piece ids of every text that is left, as digests with their number."""
    return corpus.piece_digests(docs)


STAGES = [
    ("quality classifier", reject_low_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", remove_benchmark),
    ("PII", replace_personal),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifier, the surrogates and the piece encoder can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in turn; each result but the last is written and read again.

    A stage's scratch data, and the stage before, are deleted once the stage is written.
    """
    docs, before = spark.read.parquet(f"{folder}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch_path(spark, f"stage-{k}")
        with scratch_scope(spark):
            stage(spark, docs, folder).write.parquet(path)
        if before is not None:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, folder)
