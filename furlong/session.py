"""Session settings the jobs expect. On a cluster, set the same values in its own configuration."""

from __future__ import annotations

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
SETTINGS = {
    # Timestamps are UTC instants; race days convert explicitly.
    "spark.sql.session.timeZone": "UTC",
    # Run-time plans: coalesced partitions, broadcast of sides that turn out small, split of hot partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state on disk with incremental snapshots, not on the executors' heaps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # The JVM runs methods of more bytes than this uncompiled; stages that need one, as the type gate does, are compiled
    # operator by operator instead, in small methods.
    METHOD_LIMIT: "8000",
    # Input per scan task.
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(app: str = "furlong", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
