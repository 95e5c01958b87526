"""The two starter models: a union with a missing id, and a filter on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_ids(spark: SparkSession) -> DataFrame:
    """The ids 1 and NULL."""
    return with_missing_id(spark.sql("SELECT id FROM VALUES (1) AS t(id)"))


def with_missing_id(ids: DataFrame) -> DataFrame:
    """``ids`` and one row without an id; duplicates stay."""
    missing = ids.sparkSession.sql("SELECT CAST(NULL AS BIGINT) AS id")
    return ids.unionByName(missing)


def first_id(ids: DataFrame) -> DataFrame:
    return ids.where(F.col("id") == 1)


def known_ids(ids: DataFrame) -> DataFrame:
    return ids.where(F.col("id").isNotNull())
