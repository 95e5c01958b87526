"""What micro-batches did: rows taken, rows dropped as late or as duplicates, counts observed on the way.

Spark reports these once, to listeners; here they become an audit table with a row per query run and batch.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

AUDIT = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("offered", T.LongType()),
    T.StructField("late", T.LongType()), T.StructField("duplicates", T.LongType()), T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
])
WAIT_SECONDS = 120


@dataclass
class _Run:
    rows: list[tuple] = field(default_factory=list)
    ended: threading.Event = field(default_factory=threading.Event)


class Progress(StreamingQueryListener):
    """Collects the progress of all queries of a session, a row per batch that took rows or dropped some."""

    def __init__(self) -> None:
        self.runs: dict[str, _Run] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.runs.setdefault(str(event.runId), _Run())

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        duplicates = sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in p.stateOperators)
        counts = {name: value for row in (p.observedMetrics or {}).values() for name, value in row.asDict().items()}
        if p.numInputRows or late or duplicates:
            self.runs.setdefault(str(p.runId), _Run()).rows.append((str(p.id), p.batchId, p.numInputRows, late, duplicates, counts))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.runs.setdefault(str(event.runId), _Run()).ended.set()

    def rows(self, run: str) -> list[tuple]:
        """The rows of a run that has ended. Events come in order, so the end comes after all progress."""
        found = self.runs.setdefault(run, _Run())
        if not found.ended.wait(WAIT_SECONDS):
            raise TimeoutError(f"no end of run {run} was reported")
        return found.rows


@contextmanager
def watched(spark: SparkSession) -> Iterator[Progress]:
    """A listener for the queries started inside."""
    listener = Progress()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def finish(spark: SparkSession, query: StreamingQuery, seen: Progress, audit: str) -> None:
    """Wait for a run to end and append its batches to the audit table, also if it failed."""
    try:
        query.awaitTermination()
    finally:
        rows = seen.rows(str(query.runId))
        if rows:
            spark.createDataFrame(rows, AUDIT).coalesce(1).write.mode("append").parquet(audit)


def read_audit(spark: SparkSession, audit: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(audit)
