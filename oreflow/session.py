"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that hold from a laptop to a large cluster. Partition counts are
# left to the cluster: AQE coalesces what is too fine.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a partitioned write keep one open file per outcome instead of
    # sorting every task's rows by outcome first.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # The JVM leaves methods over 8,000 bytes uncompiled, which is slower than no fused code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Of these, the ones a refresh sets for its own time, whatever session it is given: at Spark's default of 0
# every row of a checked table is sorted by outcome before it is written, on disk where memory is short.
_OF_A_REFRESH = ("spark.sql.maxConcurrentOutputFileWriters",)
# Shuffle files go when the step that wrote them has ended, not when the driver happens to collect its
# garbage, so that only those of the running steps take space. A frame that is asked twice writes them anew:
# no step of a refresh does, but others may, so this is no setting of `tuned`.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


@contextmanager
def refresh_settings(spark: SparkSession) -> Iterator[None]:
    """The settings a refresh relies on hold inside, also in a session that `tuned` has not built."""
    before = {key: spark.conf.get(key, None) for key in (*_OF_A_REFRESH, _SHUFFLES_GO)}
    for key in _OF_A_REFRESH:
        spark.conf.set(key, max(SETTINGS[key], before[key] or "0", key=int))
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session, whose executors share the machine, may go without
    that setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="oreflow-")
    return _local_folders[app]


_SCOPE = "oreflow.scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder, or in the folder of the running scope, that nothing else uses."""
    scope = spark.sparkContext.getLocalProperty(_SCOPE)
    return f"{scope or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch data of the calls inside goes to one folder, which is deleted at the end.

    Frames over such data must have been written elsewhere by then.
    """
    context = spark.sparkContext
    before = context.getLocalProperty(_SCOPE)
    folder = scratch_path(spark, "run")
    context.setLocalProperty(_SCOPE, folder)
    try:
        yield
    finally:
        context.setLocalProperty(_SCOPE, before)
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
