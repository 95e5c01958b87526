"""Incremental jobs over folders of NDJSON files.

All of them read a folder as a stream, process what is new and stop (``availableNow``); the
checkpoint remembers the files that were done. Give each job its own checkpoint folder on
storage that all executors share.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from furlong.functions.gate import accepted, gate, passes, rejected
from furlong.sources.audit import observed
from furlong.sources.commits import read_text
from furlong.sources.keyed import add_versions, insert_or_ignore
from furlong.sources.landing import records


# Size of the files that one batch takes, about; a backlog is worked off in batches of it.
BATCH_BYTES = 8 << 30


def read_new(
    spark: SparkSession, root: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A folder tree of NDJSON files as a stream; partition folders become columns.

    A batch takes about ``BATCH_BYTES``, or a number of files if that is given.
    """
    bound = ("maxFilesPerTrigger", files_per_batch) if files_per_batch else ("maxBytesPerTrigger", BATCH_BYTES)
    return spark.readStream.schema(schema).option(*bound).json(root)


def ingest(stream: DataFrame, table: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append new rows to a parquet folder, exactly once."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(table)


def distinct_keys(stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """First row per key across all batches.

    Without an event time the state keeps every key it has seen. With one, which must be among
    the keys (a catalogue is distinct per day), keys older than ``delay`` leave the state, and
    rows later than that are dropped.
    """
    if event_time:
        stream = stream.withWatermark(event_time, delay)
    return stream.dropDuplicates(keys)


def distinct_within(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """First row per key of those not more than ``delay`` apart in event time.

    The state holds a key for the delay. Rows later than the watermark, the newest event time of the batches before less
    the delay, are dropped; `furlong.streaming.progress` tells how many, and how many as duplicates.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def joined_in_time(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, delay: str, span: str) -> DataFrame:
    """Rows of two streams with one key, the right one up to ``span`` after the left one.

    Both sides are held until the slower one's watermark says that no match can come, so the state is bounded by the
    delay and the span. Rows later than the watermark are dropped and counted.
    """
    a = left.withWatermark(left_time, delay)
    b = right.withWatermark(right_time, delay).withColumnRenamed(key, "_key")
    near = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {span}"))
    return a.join(b, (F.col(key) == F.col("_key")) & near).drop("_key")


def keep_latest(
    stream: DataFrame, key: str, order: tuple[str, ...], values: tuple[str, ...], table: str, checkpoint: str,
) -> StreamingQuery:
    """The latest row of each key as a table of versions: each batch commits the keys whose latest row has changed.

    The running maximum is in the state, a row a key, so rows may come in any order. A batch that is run again finds its
    folder committed. `keyed.read_latest` reads the table, `keyed.compact_latest` keeps it short.
    """
    latest = stream.groupBy(key).agg(F.max(F.struct(*order, *values)).alias("_latest")).select(key, "_latest.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        add_versions(batch, table, f"part={stream_id(batch.sparkSession, checkpoint)}-{batch_id}")

    return (
        latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def gate_to(
    stream: DataFrame, schema: T.StructType, paths: dict[str, str], table: str, quarantine: str,
    checkpoint: str, keep: tuple[str, ...] = (), audit: str | None = None,
) -> StreamingQuery:
    """Gate landed responses: accepted rows to one folder, rejected ones with their cause to another.

    A batch that is run again after a failure replaces its own folder, so no row shows up twice. A batch is kept nowhere
    between the writes: the first one counts the rejects, and only if there are some a second pass stores them. With
    ``audit``, the counts of each batch are stored below that folder, too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        gated, rejects, written = gate(records(batch, keep), schema, paths, keep=keep), Observation(), Observation()
        seen = gated.observe(rejects, F.count_if(~passes()).alias("n"))
        kept = accepted(seen).observe(written, F.count(F.lit(1)).alias("n"))
        kept.write.mode("overwrite").json(f"{table}/batch_id={batch_id}", ignoreNullFields=False)
        failed = observed(rejects)
        if failed != 0:
            stored = Observation()
            rejected(gated, keep).observe(stored, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{quarantine}/batch_id={batch_id}")
            failed = observed(stored) or 0
        if audit:
            counts = batch.sparkSession.createDataFrame([(observed(written) or 0, failed)], "success long, failed long")
            counts.coalesce(1).write.mode("overwrite").json(f"{audit}/batch_id={batch_id}")

    return for_each_batch(stream, write, checkpoint)


def insert_new(
    stream: DataFrame, table: str, key: str, order: list[str], checkpoint: str,
    partition: str | None = None, drop: tuple[str, ...] = (),
) -> StreamingQuery:
    """Insert-or-ignore per batch. A batch that is run again adds nothing.

    Of the rows with one key the one in the earliest batch is stored, and within a batch the first in ``order``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        insert_or_ignore(batch, table, key, [F.asc(c) for c in order], drop, partition)

    return for_each_batch(stream, write, checkpoint)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to; a new checkpoint has a new one, while its batches start at 0 again."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def for_each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
