"""Writers. Every write replaces what was there, once the new data is whole.

A replacement is written beside the old data and then moved into its place, so a write that fails
leaves the old data as it was. Where a store has no cheap rename, write whole runs as versions
(``sources/versions.py``), which move nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from oreflow.sources.versions import exists, file_system, folders, hadoop_path, remove

# Earlier contents of a table that stay for queries that have started on them, the present one included.
KEPT = 2
#: Of stored tables. Row hashes and rejected rows, most of what a refresh writes, pack better than by the default.
COMPRESSION = "zstd"
#: Of text files that are read whole, each by one task, which bounds their rows. Level four takes half the time
#: of the usual six for a tenth more bytes.
PACKED_TEXT = {"compression": "gzip", "zlib.compress.level": "FOUR", "maxRecordsPerFile": 1_000_000}


def _replaced(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write straight to a new path; else beside the old data, which goes after the new is whole."""
    path = path.rstrip("/")
    if not exists(spark, path):
        write(path)
        return
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    try:
        write(fresh)
    except BaseException:
        remove(spark, fresh)
        raise
    system = file_system(spark, path)
    for source, target in ((path, old), (fresh, path)):
        if not system.rename(hadoop_path(spark, source), hadoop_path(spark, target)):
            raise OSError(f"cannot rename {source} to {target}")
    remove(spark, old)


def replace_parquet(df: DataFrame, path: str) -> None:
    def write(place: str) -> None:
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(place)

    _replaced(df.sparkSession, path, write)


def point_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    source: str = "parquet",
    **options: str,
) -> None:
    """Let a catalog table show data that is already stored; nothing is copied.

    A table of the same columns moves to the new place in one step of the catalog. Otherwise it is
    dropped and made anew; external data stays where it is.
    """
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind == "EXTERNAL" and spark.table(name).schema.simpleString() == schema.simpleString():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {name}")
    spark.catalog.createTable(name, path, source, schema, **options)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table, kept below ``path`` or the database's folder.

    The rows go to a new folder there; only then is the table pointed to it. The contents before
    stay for running queries until the next replacement.
    """
    spark = df.sparkSession
    if path is None:
        database, _, table = name.rpartition(".")
        home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
        path = f"{home}/{table}"
    path = path.rstrip("/")
    fresh = f"{path}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(fresh)
    except BaseException:
        remove(spark, fresh)
        raise
    point_table(spark, name, fresh, df.schema)
    for old in folders(spark, path)[KEPT:]:
        if not fresh.endswith(old):
            remove(spark, f"{path}/{old}")


def replace_csv(
    df: DataFrame, path: str, *, single_file: bool = False, packed: bool = False
) -> None:
    """CSV with a header; quotes inside values are doubled, blanks are kept.

    ``single_file`` is meant for reports of a few rows per dataset; anything
    larger stays one file per task. ``packed`` compresses the files.
    """
    if single_file:
        df = df.coalesce(1)
    writer = (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if packed:
        writer = writer.options(**PACKED_TEXT)
    _replaced(df.sparkSession, path, writer.csv)
