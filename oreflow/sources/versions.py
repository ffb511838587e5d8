"""Versions of an output folder, the pointer that names the one in use, and the ledger of a run.

A run writes to a folder of its own below ``versions``; readers go on with the version the pointer
names until the run has ended. The pointer is one small file, put in place by one rename, so it
names the old version or the new one and never half of either. It lists the versions
published last, newest first; the newest is in use, and the others are kept for readers that
have started on them.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable
from importlib.resources import files
from importlib.resources.abc import Traversable
from pathlib import Path

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

POINTER = "CURRENT"
VERSIONS = "versions"
_FAILED = "FAILED"
_RUN = "run.json"


def hadoop_path(spark: SparkSession, name: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def file_system(spark: SparkSession, name: str) -> JavaObject:
    return hadoop_path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    return file_system(spark, name).exists(hadoop_path(spark, name))


def remove(spark: SparkSession, name: str) -> None:
    file_system(spark, name).delete(hadoop_path(spark, name), True)


def folders(spark: SparkSession, name: str) -> list[str]:
    """Names of the folders straight below a folder, the one changed last first; none where it is missing."""
    if not exists(spark, name):
        return []
    found = [f for f in file_system(spark, name).listStatus(hadoop_path(spark, name)) if f.isDirectory()]
    return [f.getPath().getName() for f in sorted(found, key=lambda f: -f.getModificationTime())]


def read_text(spark: SparkSession, name: str) -> str | None:
    """A small file, or None where there is none."""
    if not exists(spark, name):
        return None
    stream = file_system(spark, name).open(hadoop_path(spark, name))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, name: str, text: str) -> None:
    """Put a small file in place at once: readers see the earlier text or the whole new one.

    Stores that Hadoop's file contexts know replace a file by one rename. The machine's own file
    system does so only when asked directly.
    """
    system, beside = file_system(spark, name), f"{name}.{uuid.uuid4().hex}"
    qualified = hadoop_path(spark, name).makeQualified(system.getUri(), system.getWorkingDirectory())
    if system.getUri().getScheme() == "file":
        place = Path(qualified.toUri().getPath())
        place.parent.mkdir(parents=True, exist_ok=True)
        fresh = place.with_name(beside.rsplit("/", 1)[-1])
        fresh.write_text(text, encoding="utf-8")
        os.replace(fresh, place)
        return
    stream = system.create(hadoop_path(spark, beside), True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        qualified.toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(hadoop_path(spark, beside), qualified, options)


def published(spark: SparkSession, root: str) -> list[str]:
    """The versions the pointer lists, the one in use first."""
    return (read_text(spark, f"{root.rstrip('/')}/{POINTER}") or "").split()


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{VERSIONS}/{version}"


def current_root(spark: SparkSession, root: str) -> str:
    """The folder whose tables are in use: that of the version published last, or ``root`` itself."""
    found = published(spark, root)
    return version_path(root, found[0]) if found else root


def publish(spark: SparkSession, root: str, version: str, keep: int = 2) -> None:
    """Put a finished version in use; ``keep`` of the versions published last stay, the one in use included.

    Versions that fell off the list go, and so do runs known to have failed. A run of another
    writer that is under way is left alone. Of two writers that publish at the same time the
    later one wins, whole.
    """
    listed = [version, *[v for v in published(spark, root) if v != version]]
    put_text(spark, f"{root.rstrip('/')}/{POINTER}", "\n".join(listed[: max(keep, 1)]) + "\n")
    for old in listed[max(keep, 1) :]:
        remove(spark, version_path(root, old))
    for other in folders(spark, f"{root.rstrip('/')}/{VERSIONS}"):
        if other not in listed and exists(spark, f"{version_path(root, other)}/{_FAILED}"):
            remove(spark, version_path(root, other))


def code_version() -> str:
    """Hash of the package's sources, those of its training-data operators left out."""
    digest = hashlib.sha256()

    def add(folder: Traversable, place: str) -> None:
        for entry in sorted(folder.iterdir(), key=lambda e: e.name):
            if entry.is_dir() and entry.name not in ("llm", "__pycache__"):
                add(entry, f"{place}/{entry.name}")
            elif entry.name.endswith(".py"):
                digest.update(f"{place}/{entry.name}\0".encode() + entry.read_bytes() + b"\0")

    add(files("oreflow"), "")
    return digest.hexdigest()


def input_files(spark: SparkSession, folder: str) -> list[list]:
    """Path, size and time of change of every file below a folder."""
    if not exists(spark, folder):
        return []
    listing = file_system(spark, folder).listFiles(hadoop_path(spark, folder), True)
    found = []
    while listing.hasNext():
        status = listing.next()
        found.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
    return sorted(found)


def fingerprint(spark: SparkSession, folder: str, settings: dict) -> str:
    """What a run's tables follow from: input files, settings and code."""
    told = {"files": input_files(spark, folder), "settings": settings, "code": code_version()}
    return hashlib.sha256(json.dumps(told, sort_keys=True, default=repr).encode()).hexdigest()


class Run:
    """One version being written, with a record of each step that has ended.

    A step is noted after all it wrote is stored, so a step without a note is done again, over
    whatever its first try left.
    """

    def __init__(self, spark: SparkSession, root: str, version: str, facts: dict) -> None:
        self.spark, self.root, self.version, self.facts = spark, root, version, facts
        self.path = version_path(root, version)

    @classmethod
    def start(cls, spark: SparkSession, root: str, facts: dict) -> Run:
        run = cls(spark, root, uuid.uuid4().hex, facts)
        put_text(spark, f"{run.path}/{_RUN}", json.dumps(facts))
        return run

    @classmethod
    def unfinished(cls, spark: SparkSession, root: str, print_: str) -> Run | None:
        """The last run with this fingerprint that was never published.

        The caller says by asking that no other program is still at work on it.
        """
        listed = published(spark, root)
        for version in folders(spark, f"{root.rstrip('/')}/{VERSIONS}"):
            text = None if version in listed else read_text(spark, f"{version_path(root, version)}/{_RUN}")
            if text is not None and json.loads(text)["fingerprint"] == print_:
                remove(spark, f"{version_path(root, version)}/{_FAILED}")
                return cls(spark, root, version, json.loads(text))
        return None

    def once(self, step: str, work: Callable[[], dict | None]) -> dict | None:
        """Do a step unless it is noted as done; its record either way."""
        note = f"{self.path}/ledger/{step}.json"
        text = read_text(self.spark, note)
        if text is not None:
            return json.loads(text)
        record = work()
        put_text(self.spark, note, json.dumps(record))
        return record

    def failed(self) -> None:
        put_text(self.spark, f"{self.path}/{_FAILED}", "")
