"""Readers for raw files and stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from oreflow.functions import null_if_na, quoted
from oreflow.model import SourceSpec, text_schema
from oreflow.sources.ranges import PACKED, RANGE_BYTES, UNPACKED, csv_headers, csv_records, files_below, json_objects


#: Name of the column with the file a row came from, where a reader is asked for it.
READ_FROM = "_read_from"


def _from_file(df: DataFrame, with_file: bool, file: Column) -> DataFrame:
    return df.withColumn(READ_FROM, file) if with_file else df


def _csv_options(multi_line: bool) -> dict[str, str]:
    return {"header": "true", "mode": "FAILFAST", "escape": '"', "multiLine": str(multi_line)}


def _typed(raw: DataFrame, schema: StructType | None, kept: Sequence[str] = ()) -> DataFrame:
    """Missing-value tokens as null, then the declared types; columns that a file lacks are null."""
    present = set(raw.columns)
    columns = []
    for field in schema or raw.schema:
        value = null_if_na(field.name) if field.name in present else F.lit(None).cast("string")
        if not isinstance(field.dataType, StringType):
            value = value.cast(field.dataType)
        columns.append(value.alias(field.name))
    return raw.select(*columns, *kept)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    multi_line: bool = False,
    missing_as_null: bool = False,
    with_file: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """CSV with a header row; missing-value tokens become null.

    Fields are read as text first, since the tokens would not parse as
    numbers, and cast to the declared types afterwards. Without a schema the
    header names the columns and all stay text. With one, columns are found by
    the header of each file: they may come in another order, and undeclared ones
    are left out. A declared column that a file lacks is an error, or null with
    ``missing_as_null``. A row with another number of fields than its header, or
    a value of another type, fails the job. With ``multi_line`` quoted values may
    hold line breaks; files over ``range_bytes`` are then read in ranges by many
    tasks, unless they are compressed.
    """
    listed = files_below(spark, path) if schema is not None else []
    if not listed:
        reader = spark.read.options(**_csv_options(multi_line)).option("recursiveFileLookup", True)
        if schema is not None:
            reader = reader.schema(text_schema(*schema.names))
        raw = reader.csv(path)
        return _typed(raw, schema, [F.col("_metadata.file_path").alias(READ_FROM)] if with_file else ())
    sizes = dict(listed)
    by_header: dict[tuple[str, ...], list[str]] = {}
    headers = _headers_of(spark, [name for name, size in listed if size])
    for name, header in headers.items():
        by_header.setdefault(tuple(header), []).append(name)
    frames = []
    for header, files in sorted(by_header.items()):
        lacking = [name for name in schema.names if name not in header]
        if lacking and not missing_as_null:
            raise ValueError(f"the header of {files[0]} lacks {', '.join(lacking)}")
        large = [f for f in files if multi_line and sizes[f] > range_bytes and not f.endswith(PACKED)]
        small = [f for f in files if f not in set(large)]
        # Names that come twice, or are blank, are told apart by their place.
        names = [n if n and header.count(n) == 1 else f"{n}#{k}" for k, n in enumerate(header)]
        if small:
            reader = spark.read.options(**_csv_options(multi_line)).schema(text_schema(*names))
            raw = reader.option("enforceSchema", True).csv(small)
            frames.append(_typed(raw, schema, [F.col("_metadata.file_path").alias(READ_FROM)] if with_file else ()))
        if large:
            records = csv_records(spark, [(f, sizes[f]) for f in large], range_bytes)
            options = {"mode": "FAILFAST", "escape": '"'}
            row = F.from_csv("value", ", ".join(f"{quoted(n)} STRING" for n in names), options)
            raw = records.select(row.alias("row"), F.col("file").alias(READ_FROM)).select("row.*", READ_FROM)
            frames.append(_typed(raw, schema, [READ_FROM] if with_file else ()))
    if not frames:
        empty = spark.createDataFrame([], schema)
        return _from_file(empty, with_file, F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, frames)


def _headers_of(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """By Arrow where it knows the store, else by Spark, one small job a file."""
    known = [f for f in files if not f.endswith(PACKED) or f.endswith(tuple(UNPACKED))]
    try:
        found = csv_headers(spark, known)
    except (OSError, ValueError):
        found = {}
    rest = [f for f in files if f not in found]
    return found | {f: spark.read.options(**_csv_options(False)).csv(f).columns for f in rest}


def _json(spark: SparkSession, schema: StructType) -> DataFrameReader:
    """A raw path is a pile of files: folder names below it are no columns."""
    return (
        spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", True)
    )


def read_json_array(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    with_file: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Files that each hold one JSON array of objects.

    A file of up to ``range_bytes`` is read by one task. A larger one is read in
    ranges by many tasks, unless it is compressed: it must be UTF-8 then. A broken
    file fails the job either way.
    """
    large = [
        (name, size)
        for name, size in files_below(spark, path)
        if size > range_bytes and not name.endswith(PACKED)
    ]
    if not large:
        raw = _json(spark, schema).option("multiLine", True).json(path)
        return raw.select("*", F.col("_metadata.file_path").alias(READ_FROM)) if with_file else raw
    split = {name for name, _ in large}
    objects = json_objects(spark, large, range_bytes)
    row = F.from_json("value", schema, {"mode": "FAILFAST"})
    frames = [objects.select(row.alias("row"), F.col("file").alias(READ_FROM)).select("row.*", READ_FROM)]
    small = [name for name, size in files_below(spark, path) if size and name not in split]
    if small:
        raw = _json(spark, schema).option("multiLine", True).json(small)
        frames.append(raw.select("*", F.col("_metadata.file_path").alias(READ_FROM)))
    both = reduce(DataFrame.unionByName, frames)
    return both if with_file else both.drop(READ_FROM)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON object per line; blank lines are skipped, a bad line fails the job."""
    return _json(spark, schema).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Full scan of a catalog table."""
    return spark.table(name)


def read_raw(
    spark: SparkSession, spec: SourceSpec, folder: str, *, with_file: bool = False
) -> DataFrame:
    """Read a registered raw dataset; a missing file raises PATH_NOT_FOUND.

    ``with_file`` adds READ_FROM, the file each row came from.
    """
    path = f"{folder.rstrip('/')}/{spec.file_name}"
    if spec.file_format == "csv":
        return read_csv(
            spark, path, spec.schema, multi_line=spec.multi_line, with_file=with_file
        )
    if spec.file_format == "json":
        return read_json_array(spark, path, spec.schema, with_file=with_file)
    if spec.file_format == "jsonl":
        lines = read_json_lines(spark, path, spec.schema)
        return lines.select("*", F.col("_metadata.file_path").alias(READ_FROM)) if with_file else lines
    raise ValueError(f"unsupported raw format {spec.file_format!r} of {spec.name}")
