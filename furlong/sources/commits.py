"""Folders of parquet files that change by atomic commits.

A table is a folder with ``data/`` and ``_commits/``. A writer stores its rows in a folder of its own below ``data/`` and
then publishes version n + 1: a manifest that lists all folders of the table, created only if no one else has created
that version (rename without overwrite, which file systems that Spark keeps its own stream logs on do atomically). A
writer that comes second finds out, looks at what was added meanwhile, and tries the next version. Readers take the
newest manifest, so they see whole commits only; rows of a writer that failed or lost are in no manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Commits that one writer may lose in a row; each lost one is a commit that another writer has made.
TRIES = 100


@dataclass(frozen=True)
class Version:
    """A published state: its number (0: none yet) and its folders below ``data/``, oldest first."""

    number: int
    folders: tuple[str, ...]


def newest(spark: SparkSession, path: str) -> Version:
    """The newest published version."""
    place = _path(spark, _commits(path))
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(place):
        return Version(0, ())
    names = [f.getPath().getName() for f in store.listStatus(place)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]
    if not numbers:
        return Version(0, ())
    return Version(max(numbers), tuple(json.loads(read_text(spark, f"{_commits(path)}/{_name(max(numbers))}"))["folders"]))


def read(spark: SparkSession, path: str, schema: T.StructType, folders: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of the newest version, or of the given folders of it."""
    if folders is None:
        folders = newest(spark, path).folders
    if not folders:
        return spark.createDataFrame([], schema)
    # Each folder has its own partition folders below it, found from the common base.
    base = f"{path.rstrip('/')}/data"
    return spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/{f}" for f in folders)).select(*schema.names)


def stage(rows: DataFrame, path: str, partition: str | None = None, folder: str | None = None) -> str:
    """Store rows in a folder that no version lists yet, and return its name."""
    folder = folder or f"part={uuid.uuid4().hex}"
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(f"{path.rstrip('/')}/data/{folder}")
    return folder


def publish(spark: SparkSession, path: str, version: Version) -> bool:
    """Create the manifest of a version; False if that number exists already."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = _path(spark, _commits(path))
    store = folder.getFileSystem(conf)
    store.mkdirs(folder)
    target, draft = jvm.org.apache.hadoop.fs.Path(folder, _name(version.number)), jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    out = store.create(draft, False)
    try:
        out.write(bytearray(json.dumps({"version": version.number, "folders": version.folders}).encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    kinds = spark.sparkContext._gateway.new_array(rename, 1)
    kinds[0] = rename.NONE  # do not overwrite
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), conf).rename(store.makeQualified(draft), store.makeQualified(target), kinds)
    except Py4JJavaError as e:
        store.delete(draft, False)
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def commit(
    spark: SparkSession, path: str, seen: Version, folder: str, rebase: Callable[[str, tuple[str, ...]], str | None] = lambda folder, added: folder,
    replaces: tuple[str, ...] = (),
) -> str | None:
    """Publish a staged folder on top of the version that its rows were made from, in place of the folders it replaces.

    If others have published meanwhile, ``rebase(folder, added)`` gives the name of a folder that is right after
    theirs, or None if nothing is left to add. Returns the name of the folder that was published, if any.
    """
    for _ in range(TRIES):
        if publish(spark, path, Version(seen.number + 1, (*(f for f in seen.folders if f not in replaces), folder))):
            return folder
        now = newest(spark, path)
        if not set(replaces) <= set(now.folders):  # replaced by another writer already
            discard(spark, path, folder)
            return None
        next_one = rebase(folder, tuple(f for f in now.folders if f not in seen.folders))
        if next_one != folder:
            discard(spark, path, folder)
        if next_one is None:
            return None
        seen, folder = now, next_one
    raise RuntimeError(f"{path}: {TRIES} commits of other writers came first")


def compact(spark: SparkSession, path: str, rows: DataFrame, seen: Version, partition: str | None = None) -> str | None:
    """Put one folder with ``rows``, made from all folders of ``seen``, in their place; commits made meanwhile stay.

    The old folders are left for readers of older versions.
    """
    return commit(spark, path, seen, stage(rows, path, partition), replaces=seen.folders)


def discard(spark: SparkSession, path: str, folder: str) -> None:
    """Remove a folder that was staged here and is in no manifest."""
    place = _path(spark, f"{path.rstrip('/')}/data/{folder}")
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def read_text(spark: SparkSession, name: str) -> str:
    """A small file of the shared file system, read on the driver."""
    place = _path(spark, name)
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _path(spark: SparkSession, name: str) -> JavaObject:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _commits(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def _name(number: int) -> str:
    return f"{number:020}.json"
