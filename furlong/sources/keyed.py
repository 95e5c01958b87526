"""Keyed tables that change by atomic commits: insert-or-ignore, where the first row of a key stays, and latest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.operators.keyed import first_per_key, not_in
from furlong.sources import commits

# Up to so many different partitions of a batch are named in the filter on the target.
NAMED_PARTITIONS = 10_000


def read_keyed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the newest commit; none if the table does not exist yet."""
    return commits.read(spark, path, schema)


def new_rows(
    batch: DataFrame, target: DataFrame, key: str, order: list, partition: str | None = None
) -> DataFrame:
    """First row per key of the batch, without keys the target has.

    With ``partition``, a column the key determines (the day inside a race id, say) and by which the target is stored
    (never NULL), only the target partitions that the batch touches are read: they are looked up first. A batch of more
    than ``NAMED_PARTITIONS`` reads all of the target.
    """
    if partition:
        touched = batch.select(partition).distinct().limit(NAMED_PARTITIONS + 1).collect()
        if len(touched) <= NAMED_PARTITIONS:
            target = target.where(F.col(partition).isin([r[0] for r in touched]))
    return not_in(first_per_key(batch, [key], order), target, [key])


def insert_or_ignore(
    batch: DataFrame, path: str, key: str, order: list, drop: tuple[str, ...] = (),
    partition: str | None = None,
) -> int:
    """Add the new rows in one commit, and return their number. Running the same batch again adds nothing.

    Writers may run at the same time: of two that add the same key, the one that commits first has it; the other takes
    the key out of what it has staged, comparing it with the folders that came in between, and tries again.
    """
    spark = batch.sparkSession
    columns = [c for c in batch.columns if c not in drop]
    schema = T.StructType([batch.schema[c] for c in columns])
    seen = commits.newest(spark, path)
    fresh = new_rows(batch, commits.read(spark, path, schema, seen.folders), key, order, partition).select(*columns)

    def stored(*folders: str) -> DataFrame:
        return commits.read(spark, path, schema, folders)

    def rebase(folder: str, added: tuple[str, ...]) -> str | None:
        mine, theirs = stored(folder), stored(*added)
        if mine.join(theirs, key, "left_semi").isEmpty():
            return folder
        rest = commits.stage(not_in(mine, theirs, [key]), path, partition)
        if not stored(rest).isEmpty():
            return rest
        commits.discard(spark, path, rest)
        return None

    folder = commits.stage(fresh, path, partition)
    if stored(folder).isEmpty():
        commits.discard(spark, path, folder)
        return 0
    published = commits.commit(spark, path, seen, folder, rebase)
    return stored(published).count() if published else 0


def add_versions(rows: DataFrame, path: str, folder: str, partition: str | None = None) -> None:
    """Add rows that may be newer versions of stored ones, in one commit. A folder that is in the table is not added again."""
    spark = rows.sparkSession
    seen = commits.newest(spark, path)
    if folder not in seen.folders:
        commits.commit(spark, path, seen, commits.stage(rows, path, partition, folder))


def read_latest(spark: SparkSession, path: str, schema: T.StructType, key: str, order: tuple[str, ...]) -> DataFrame:
    """The latest version of each key: a maximum, merged in the map tasks, without a sort."""
    stored = commits.read(spark, path, schema)
    latest = F.max_by(F.struct(*schema.names), F.struct(*order))
    return stored.groupBy(F.col(key).alias("_key")).agg(latest.alias("_row")).select("_row.*")


def compact_latest(spark: SparkSession, path: str, schema: T.StructType, key: str, order: tuple[str, ...], partition: str | None = None) -> None:
    """Replace the folders of a table of versions by one that holds the latest of each key."""
    seen = commits.newest(spark, path)
    if len(seen.folders) > 1:
        commits.compact(spark, path, read_latest(spark, path, schema, key, order), seen, partition)
