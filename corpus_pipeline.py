"""The corpus pipeline: documents in, token ids out, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns the columns of documents;
the last returns the digests of the encoded texts. Between stages the rows are written as Parquet and read again.

SQL can express none of the stages whole (filters fitted on the data, fingerprint components, latent retrieval, byte
pairs), so ORACLE_SQL is None; tests/llm checks each operator against plain Python, and the stages of the chain for what
they keep.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.llm import bpe, decontamination, langid, simhash, substring
from furlong.llm.common import held_out, saved, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text is rejected if it is `und`, or if the winning language knows fewer than this share of its letter runs.
MIN_KNOWN = 0.05
#: Rows of a batch between the JVM and Python. Whole texts travel, some of them long, and both sides hold a batch for each
#: running task: with Spark's 10,000 rows that was some 100 MB a task on either side.
ARROW_ROWS = 500


def small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage in a session whose batches are small; the setting stays, as the rows are computed later."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an identified language, with the prediction as `lang`. Texts that are null or have no letter go."""
    filters = langid.train(docs.where(~held_out(F.col("doc_id"))))
    done = langid.predict(docs, filters, keep=("doc_id", "text", "source", "n_chars"))
    return done.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("known") >= MIN_KNOWN)).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one of smallest id, and of rows with that id one.

    Rows without an id: of those with one fingerprint, one stays if no row with an id is in their component.
    """
    found = simhash.components(docs)
    stay = found.where(F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))).select("doc_id", "fp").distinct()
    with_id = docs.where("doc_id is not null").join(stay.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    loose = saved(docs.where("doc_id is null"))
    if loose.isEmpty():
        return with_id.select(*COLUMNS)
    # Without an id, a text stands for itself.
    texts = loose.withColumn("doc_id", F.xxhash64("text"))
    prints = simhash.fingerprints(texts).join(stay.where("doc_id is null").select("fp"), "fp", "left_semi")
    kept = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    rest = texts.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).withColumn("doc_id", F.lit(None).cast("long"))
    return with_id.select(*COLUMNS).unionByName(rest.select(*COLUMNS))


@small_batches
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; texts lose the words of repeated windows. Texts that lose nothing stay as they are."""
    done = substring.remove_repeats(docs, keep=COLUMNS)
    cut = F.col("n_removed") > 0
    return done.withColumns({
        "text": F.when(cut, F.col("kept_text")).otherwise(F.col("text")), "n_chars": F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("n_chars").cast("long")),
    }).select(*COLUMNS)


@small_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. A text without an id goes by a hash of the text."""
    own = F.coalesce("doc_id", F.xxhash64("text"))
    found = decontamination.leaks(docs.withColumn("doc_id", own), table(spark, sf_dir, "benchmark"))
    gone = found.select(F.col("doc_id").alias("_own")).distinct()
    return docs.withColumn("_own", own).join(gone, "_own", "left_anti").select(*COLUMNS)


@small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids_sha256`, `decoded_sha256` of every document."""
    return bpe.digests(docs)


STAGES = [
    ("language_id", language), ("simhash_near_dedup", near_duplicates), ("substring_dedup", substrings),
    ("benchmark_decontamination", decontaminate), ("byte_level_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = saved(docs)
    return docs
