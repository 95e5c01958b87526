"""The daily Bronze run: catalogue, book, or both."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.functions.dates import ZONE
from furlong.functions.gate import accepted, passes, rejected
from furlong.plans.markets import books_of, gated_book, gated_catalogue, of_day
from furlong.schemas import CATALOGUE
from furlong.sources import commits
from furlong.sources.audit import observed
from furlong.sources.bronze import has_files, has_run, read_ndjson, write_run
from furlong.sources.keyed import add_versions

RESULTS = T.StructType([
    T.StructField("feed", T.StringType()), T.StructField("extracted_date", T.DateType()), T.StructField("run_time", T.StringType()),
    T.StructField("skipped", T.BooleanType()), T.StructField("success", T.LongType()), T.StructField("failed", T.LongType()),
])
MODES = ("catalogue", "book", "all")


@dataclass(frozen=True)
class RunResult:
    """Outcome of one feed: skipped as already there, or record counts."""

    skipped: bool
    success: int = 0
    failed: int = 0

    @property
    def go_on(self) -> bool:
        """Does the book run follow? Yes after new rows, and yes after a skip."""
        return self.skipped or self.success > 0


@dataclass(frozen=True)
class BronzePaths:
    catalogue: str
    book: str
    quarantine: str


def run_catalogue(
    responses: DataFrame, paths: BronzePaths, day: str, now: datetime,
    overwrite: bool = False, records_per_file: int | None = None,
) -> RunResult:
    """Write the day's valid markets, and the rejected ones with their cause aside.

    Responses carry ``extracted_date``, the day they landed for; no other day is read. Of the accepted markets those that
    start on another local day are left out; every reject of the day is kept. A day that has files is skipped unless
    ``overwrite``, which adds a run folder, or replaces the folder of the same minute.
    """
    spark = responses.sparkSession
    if not overwrite and has_files(spark, paths.catalogue, day):
        return RunResult(skipped=True)
    gated = of_day(gated_catalogue(_landed_for(responses, day)), F.lit(day).cast("date"))
    return _write(gated, accepted, f"{paths.quarantine}/catalogue", paths.catalogue, day, now, records_per_file)


def run_book(
    spark: SparkSession, responses: DataFrame, paths: BronzePaths, day: str, now: datetime,
    overwrite: bool = False, records_per_file: int | None = None,
) -> RunResult:
    """Write the day's valid books of the markets in the day's catalogue, all runs of it."""
    if not overwrite and has_files(spark, paths.book, day):
        return RunResult(skipped=True)
    catalogue = read_ndjson(spark, paths.catalogue, CATALOGUE, day)
    wanted = lambda gated: books_of(accepted(gated), catalogue)
    return _write(gated_book(_landed_for(responses, day)), wanted, f"{paths.quarantine}/book", paths.book, day, now, records_per_file)


def run(
    mode: str, catalogue_responses: DataFrame | None, book_responses: DataFrame | None, paths: BronzePaths,
    day: str | None = None, now: datetime | None = None, overwrite: bool = False,
    records_per_file: int | None = None, audit: str | None = None,
) -> dict[str, RunResult]:
    """Run one feed or both. ``all`` runs the book only if the catalogue has rows for the day.

    With ``audit`` the outcome of every run, skipped ones too, is added to the table there (`read_results`).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    now = now or datetime.now(timezone.utc)
    day = day or now.astimezone(ZoneInfo(ZONE)).strftime("%Y-%m-%d")
    results: dict[str, RunResult] = {}
    if mode in ("catalogue", "all"):
        results["catalogue"] = run_catalogue(catalogue_responses, paths, day, now, overwrite, records_per_file)
    if mode == "book" or (mode == "all" and results["catalogue"].go_on):
        results["book"] = run_book(
            book_responses.sparkSession, book_responses, paths, day, now, overwrite, records_per_file
        )
    if audit:
        spark = (book_responses if catalogue_responses is None else catalogue_responses).sparkSession
        add_versions(results_table(spark, results, day, now), audit, f"part={uuid.uuid4().hex}")
    return results


def read_results(spark: SparkSession, audit: str) -> DataFrame:
    """Outcomes of all runs."""
    return commits.read(spark, audit, RESULTS)


def results_table(spark: SparkSession, results: dict[str, RunResult], day: str, now: datetime) -> DataFrame:
    """The outcome of a run as rows: ``feed``, ``extracted_date``, ``run_time``, ``skipped``, ``success``, ``failed``."""
    rows = [(feed, day, _run_time(now), r.skipped, r.success, r.failed) for feed, r in results.items()]
    table = spark.createDataFrame(rows, "feed string, extracted_date string, run_time string, skipped boolean, success bigint, failed bigint")
    return table.withColumn("extracted_date", F.col("extracted_date").cast("date"))


def _landed_for(responses: DataFrame, day: str) -> DataFrame:
    return responses.where(F.col("extracted_date") == F.lit(day).cast("date"))


def _write(gated, rows_to_keep, quarantine, root, day, now, records_per_file) -> RunResult:
    run_time = _run_time(now)
    # The write counts what it stores, and the rejects below the gate's filter. Usually there are none and the
    # responses are read once; only if there are some, or the planner skipped that branch, a second pass stores them.
    rejects, written, stored = Observation(), Observation(), Observation()
    seen = gated.observe(rejects, F.count_if(~passes()).alias("n"))
    kept = rows_to_keep(seen).observe(written, F.count(F.lit(1)).alias("n"))
    success, failed = write_run(kept, root, day, run_time, written, records_per_file), 0
    if observed(rejects) != 0 or has_run(gated.sparkSession, quarantine, day, run_time):
        failed = write_run(rejected(gated).observe(stored, F.count(F.lit(1)).alias("n")), quarantine, day, run_time, stored)
    return RunResult(skipped=False, success=success, failed=failed)


def _run_time(now: datetime) -> str:
    return now.astimezone(ZoneInfo(ZONE)).strftime("%H-%M")
