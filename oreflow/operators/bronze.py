"""Bronze: source rows plus load metadata."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from oreflow.functions import quoted, row_hash
from oreflow.sources.readers import READ_FROM

LOAD_AUDIT_SCHEMA = StructType(
    [
        StructField("bronze_load_id", StringType()),
        StructField("dataset_name", StringType()),
        StructField("source_file", StringType()),
        StructField("source_system", StringType()),
        StructField("file_format", StringType()),
        StructField("row_count", LongType()),
        StructField("column_count", LongType()),
        StructField("loaded_at_utc", StringType()),
        StructField("status", StringType()),
    ]
)


#: Columns that bronze adds, in order.
METADATA = (
    "_bronze_load_id",
    "_ingested_at_utc",
    "_source_file",
    "_source_system",
    "_raw_row_hash",
)


def add_load_metadata(
    df: DataFrame,
    *,
    load_id: str,
    ingested_at: str,
    source_system: str,
    source_file: str | None = None,
) -> DataFrame:
    """Append load id, ingestion time, source file and source system.

    Without ``source_file`` each row names the file it was read from, which
    is what a folder of part files needs.
    """
    # Readers that put files together, or read one in ranges, name the file in a column.
    told = READ_FROM in df.columns
    read_from = F.element_at(F.split(READ_FROM, "/"), -1) if told else F.col("_metadata.file_name")
    file_name = F.lit(source_file) if source_file else read_from
    return df.select(
        *[F.col(quoted(name)) for name in df.columns if name != READ_FROM],
        F.lit(load_id).alias("_bronze_load_id"),
        F.lit(ingested_at).alias("_ingested_at_utc"),
        file_name.alias("_source_file"),
        F.lit(source_system).alias("_source_system"),
    )


def add_row_hash(
    df: DataFrame, *, include_metadata: bool = True, name: str = "_raw_row_hash"
) -> DataFrame:
    """Append a fingerprint of the row.

    By default it covers the load metadata too, so equal source rows agree
    within one load only. ``include_metadata=False`` leaves out columns that
    start with an underscore and gives a fingerprint comparable across loads.
    """
    covered = [c for c in df.columns if include_metadata or not c.startswith("_")]
    return df.withColumn(name, row_hash(covered))


def to_bronze(
    df: DataFrame,
    *,
    load_id: str,
    ingested_at: str,
    source_system: str,
    source_file: str | None = None,
) -> DataFrame:
    return add_row_hash(
        add_load_metadata(
            df,
            load_id=load_id,
            ingested_at=ingested_at,
            source_system=source_system,
            source_file=source_file,
        )
    )


def load_audit(spark: SparkSession, records: Iterable[dict]) -> DataFrame:
    """One row per loaded dataset."""
    names = LOAD_AUDIT_SCHEMA.names
    rows = [tuple(record[name] for name in names) for record in records]
    return spark.createDataFrame(rows, LOAD_AUDIT_SCHEMA)


def count_load(
    bronze: DataFrame, *, load_id: str, dataset_name: str, source_file: str,
    source_system: str, file_format: str, loaded_at: str,
) -> DataFrame:
    """The audit row of one bronze table, counted by Spark when it is read.

    On a stored Parquet table the count comes from the file footers.
    """
    columns = len(bronze.columns)
    return bronze.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(load_id).alias("bronze_load_id"),
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(source_file).alias("source_file"),
        F.lit(source_system).alias("source_system"),
        F.lit(file_format).alias("file_format"),
        "row_count",
        F.lit(columns).cast("bigint").alias("column_count"),
        F.lit(loaded_at).alias("loaded_at_utc"),
        F.lit("success").alias("status"),
    )
