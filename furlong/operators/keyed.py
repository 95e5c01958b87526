"""One row per key: first, latest, distinct, and rows not in a target yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in ``order``; make the order total for a fixed result.

    ``row_number() = 1`` is planned with a group limit below the shuffle: every task keeps one
    row per key before it sends anything, so a key that holds a third of all rows sends one
    row per map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def top_per_key(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each key; planned with the same group limit."""
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def latest_snapshot(
    df: DataFrame, keys: list[str], ties: tuple[str, ...], snapshot: tuple[str, ...] = ("extracted_date", "run_time"),
) -> DataFrame:
    """The row of the newest snapshot per key; among rows of one snapshot the highest in ``ties``."""
    return first_per_key(df, keys, [F.desc(c) for c in (*snapshot, *ties)])


def distinct_in_order(df: DataFrame, key: str, position: str) -> DataFrame:
    """Distinct non-null keys with the position at which each was seen first."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(position).alias("first_seen"))


def not_in(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the target."""
    return df.join(target.select(*keys), keys, "left_anti")


def any_row(df: DataFrame) -> DataFrame:
    """One row, one column: is there a row at all?"""
    return df.select(F.lit(1).alias("_one")).limit(1).agg((F.count("_one") > 0).alias("has_rows"))
