"""Landed service responses: one row per response, its JSON text in ``body``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.operators.stage import compute_once


def read_responses(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Responses landed as JSON lines with a text ``body`` (and status, date, ... as in ``schema``)."""
    return spark.read.schema(schema).json(path)


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Raw bodies, one response per line."""
    return spark.read.text(path).withColumnRenamed("value", "body")


def records(responses: DataFrame, keep: tuple[str, ...] = (), body: str = "body") -> DataFrame:
    """One row per element of an array response, as VARIANT ``record``.

    An empty array has no rows. A body that is no JSON array gives one row with a NULL record,
    which the gate rejects, so nothing gets lost unseen.
    """
    items = F.try_variant_get(F.try_parse_json(body), "$", "array<variant>")
    unreadable = F.array(F.lit(None).cast("variant"))
    return responses.select(*keep, F.explode(F.coalesce(items, unreadable)).alias("record"))


def meetings(responses: DataFrame) -> DataFrame:
    """Meetings of the dates that answered 200: the ``meetings`` array, empty if missing."""
    items = F.try_variant_get(F.try_parse_json("body"), "$.meetings", "array<variant>")
    answered = responses.where(F.col("http_status") == 200)
    return answered.select("meeting_date", F.explode(items).alias("meeting")).select(
        "meeting_date",
        F.try_variant_get("meeting", "$.slug", "string").alias("slug"),
        F.try_variant_get("meeting", "$.track", "string").alias("track"),
    )


def meeting_rejects(responses: DataFrame) -> DataFrame:
    """Answers 200 that hold no meetings because they cannot be read: no JSON object, or ``meetings`` that is no array.

    A missing or null ``meetings`` is an answer without meetings.
    """
    body = F.try_parse_json("body")
    kind = F.schema_of_variant(F.try_variant_get(body, "$.meetings", "variant"))
    fine = F.schema_of_variant(body).startswith("OBJECT") & (kind.isNull() | (kind == "VOID") | kind.startswith("ARRAY"))
    return responses.where((F.col("http_status") == 200) & ~F.coalesce(fine, F.lit(False)))


def forms(responses: DataFrame) -> DataFrame:
    """Form responses with the parsed object in ``form``; NULL where the body is no JSON."""
    keep = [c for c in responses.columns if c != "body"]
    return compute_once(responses, keep, {"form": F.try_parse_json("body")})
