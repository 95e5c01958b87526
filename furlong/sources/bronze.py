"""Bronze NDJSON: one JSON object per line under extracted_date=/run_time= folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.schemas import PARTITION_COLUMNS, with_partitions
from furlong.sources.audit import observed

# Records per file of the two Bronze feeds, for consumers that rely on small
# files. The default below is no cap: at volume, small files cost more than they help.
CATALOGUE_RECORDS_PER_FILE = 50
BOOK_RECORDS_PER_FILE = 8


def write_ndjson(
    df: DataFrame, root: str, records_per_file: int | None = None, many_days: bool = False, replace: bool = False,
) -> None:
    """Add rows to their date and run folders. NULL fields are written, not left out.

    Each run writes its own ``run_time`` folder, and a forced second run adds another one beside
    it; with ``replace``, rows that are in the folders written to go, other folders stay. A run of one day writes its rows where they are, without a shuffle.
    For a backfill of ``many_days`` each task would write a small file per day, so rows are
    brought together by folder first; the adaptive planner splits large folders and merges small
    ones, so that a day that holds most rows does not end up in one task.
    """
    if many_days:
        df = df.hint("rebalance", *PARTITION_COLUMNS)
    writer = df.write.mode("overwrite" if replace else "append").option("partitionOverwriteMode", "dynamic")
    writer = writer.partitionBy(*PARTITION_COLUMNS).option("ignoreNullFields", "false")
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.json(root)


def read_ndjson(spark: SparkSession, root: str, schema: T.StructType, day: str | None = None) -> DataFrame:
    """All runs of a day, or the whole feed.

    With a day, only that day's folder is listed; the rest of the tree is not touched.
    """
    reader = spark.read.schema(with_partitions(schema)).option("basePath", root)
    if day is None:
        return reader.json(root)
    if not has_files(spark, root, day):
        return spark.createDataFrame([], with_partitions(schema))
    return reader.json(_day_folder(root, day))


def has_files(spark: SparkSession, root: str, day: str) -> bool:
    """Is there any file for the day? An empty file counts. The folder is listed, no file is read."""
    return _any_file(spark, _day_folder(root, day))


def has_run(spark: SparkSession, root: str, day: str, run_time: str) -> bool:
    """Is there any file of that run of the day?"""
    return _any_file(spark, _run_folder(root, day, run_time))


def _any_file(spark: SparkSession, folder: str) -> bool:
    """Stops at the first file; hidden ones do not count. No file is read: a scan would pass over empty ones."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return False
    found = store.listFiles(path, True)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def write_run(df: DataFrame, root: str, day: str, run_time: str, counted: Observation, records_per_file: int | None = None) -> int:
    """Store the rows as that run of the day, in place of what it held, and return their number, which ``df`` observes as ``n``.

    A run without rows leaves no folder, or an empty file where the run had rows before.
    """
    write_ndjson(stamp(df, day, run_time), root, records_per_file, replace=True)
    n = observed(counted) or 0
    if n == 0 and has_run(df.sparkSession, root, day, run_time):
        df.limit(0).write.mode("overwrite").json(_run_folder(root, day, run_time))
    return n


def stamp(df: DataFrame, day: str, run_time: str) -> DataFrame:
    """Partition values of a run."""
    return df.withColumns({"extracted_date": F.lit(day).cast("date"), "run_time": F.lit(run_time)})


def _day_folder(root: str, day: str) -> str:
    return f"{root.rstrip('/')}/extracted_date={day}"


def _run_folder(root: str, day: str, run_time: str) -> str:
    return f"{_day_folder(root, day)}/run_time={run_time}"
