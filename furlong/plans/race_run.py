"""The race-history run: stores races, the forms that made none, and the counts of both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.plans.race_history import attempted_rows
from furlong.schemas import RACE
from furlong.sources import commits
from furlong.sources.keyed import add_versions, insert_or_ignore, read_keyed

ATTEMPT = T.StructType([*RACE.fields, T.StructField("meeting_date", T.DateType()), T.StructField("arrival", T.LongType())])
STORED = T.StructType([*ATTEMPT.fields, T.StructField("run_id", T.StringType())])
COUNTS = T.StructType([T.StructField("run_id", T.StringType()), *(T.StructField(n, T.LongType()) for n in ("attempted", "inserted", "ignored", "rejected"))])


@dataclass(frozen=True)
class RacePaths:
    races: str
    attempts: str
    audit: str


def run_history(responses: DataFrame, tracks: DataFrame, paths: RacePaths, run_id: str, now: Column) -> DataFrame:
    """Store a run's races, rejects and counts; returns its row of counts.

    The forms are parsed once, into the run's folder of attempts: good ones, and rejects beside them. Good ones then go
    to the races, where the first row of an id stays. All counts are taken from stored rows, so a run that stopped
    half-way is simply run again under its id: it replaces its attempts, adds the races that are not there yet and is
    counted once.
    """
    spark, folder = responses.sparkSession, f"{paths.attempts.rstrip('/')}/run_id={run_id}"
    attempted_rows(responses, tracks, now).write.mode("overwrite").partitionBy("good").parquet(folder)
    attempts = _attempts(spark, folder)
    good = attempts.where("good").drop("good").withColumn("run_id", F.lit(run_id))
    insert_or_ignore(good, paths.races, "race_id", [F.asc("arrival")], partition="meeting_date")
    inserted = read_races(spark, paths.races).where(F.col("run_id") == run_id).agg(F.count(F.lit(1)).alias("inserted"))
    counts = attempts.agg(F.count(F.lit(1)).alias("attempted"), F.count_if(~F.col("good")).alias("rejected")).join(F.broadcast(inserted))
    row = counts.withColumn("run_id", F.lit(run_id)).withColumn("ignored", F.expr("attempted - inserted - rejected")).select(*COUNTS.names)
    add_versions(row, paths.audit, f"part={run_id}")
    return read_counts(spark, paths.audit).where(F.col("run_id") == run_id)


def read_races(spark: SparkSession, path: str) -> DataFrame:
    """Stored races, with ``meeting_date``, ``arrival`` and the run that added them."""
    return read_keyed(spark, path, STORED)


def read_rejects(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Attempts of a run that made no race."""
    return _attempts(spark, f"{path.rstrip('/')}/run_id={run_id}").where("NOT good").drop("good")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts of all runs: attempted = inserted + ignored (their id was there) + rejected."""
    return commits.read(spark, path, COUNTS)


def _attempts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(T.StructType([*ATTEMPT.fields, T.StructField("good", T.BooleanType())])).parquet(folder)
