"""Token counts by an exact length histogram.

Documents are counted by encoded length before any shuffle of single rows; suffix sums over the histogram then answer
every question about lengths, totals and context limits without reading the documents again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm import bpe
from furlong.llm.common import saved

BUCKET = 1024


def length_histogram(docs: DataFrame, vocabulary: str = bpe.VOCABULARY, text: str = "text") -> DataFrame:
    """`n_tokens`, `n_docs`: how many rows have that encoded length. Null texts have length 0; no rows, no result."""
    return bpe.token_lengths(docs, vocabulary, text).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length L that occurs, seen as context limit:

    docs_longer, tokens_longer: documents of more than L tokens and their tokens; tokens_up_to: tokens of the others;
    truncated_total: tokens left if every document is cut to L; share_up_to: share of documents that fit whole.

    Sums run inside buckets of BUCKET lengths and are shifted by the sums of the later buckets, so no window holds more
    than BUCKET rows; the buckets number at most the longest length / BUCKET. The histogram is stored first, since both
    levels of sums read it: texts are encoded once.
    """
    h = saved(histogram).withColumns({"bucket": F.floor(F.col("n_tokens") / BUCKET), "n_total": F.col("n_tokens") * F.col("n_docs")})
    per = h.groupBy("bucket").agg(F.sum("n_docs").alias("b_docs"), F.sum("n_total").alias("b_total"))
    later = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    per = per.select(
        "bucket", F.coalesce(F.sum("b_docs").over(later), F.lit(0)).alias("later_docs"), F.coalesce(F.sum("b_total").over(later), F.lit(0)).alias("later_total"),
        F.sum("b_docs").over(everything).alias("all_docs"), F.sum("b_total").over(everything).alias("all_total"),
    )
    rest = Window.partitionBy("bucket").orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    longer = h.join(per, "bucket").withColumns({
        "docs_longer": F.coalesce(F.sum("n_docs").over(rest), F.lit(0)) + F.col("later_docs"),
        "tokens_longer": F.coalesce(F.sum("n_total").over(rest), F.lit(0)) + F.col("later_total"),
    })
    return longer.select(
        "n_tokens", "n_docs", "docs_longer", "tokens_longer", (F.col("all_total") - F.col("tokens_longer")).alias("tokens_up_to"),
        (F.col("all_total") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("share_up_to"),
    )


def total_at(sums: DataFrame, limits: list[int]) -> DataFrame:
    """`limit`, `truncated_total`: tokens left if every document is cut to the limit, for limits of any size."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "limit long")
    # The largest length that occurs up to the limit decides: beyond it each longer document gives `limit` tokens.
    below = sums.join(F.broadcast(asked), F.col("n_tokens") <= F.col("limit")).groupBy("limit").agg(F.max_by(F.struct("tokens_up_to", "docs_longer"), "n_tokens").alias("x"))
    everything = sums.agg(F.sum("n_docs").alias("n"))
    return asked.join(below, "limit", "left").join(F.broadcast(everything), F.lit(True)).select(
        "limit", F.coalesce(F.col("x.tokens_up_to") + F.col("limit") * F.col("x.docs_longer"), F.col("limit") * F.col("n"), F.lit(0)).alias("truncated_total"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """`n_tokens`: the smallest length that at least a share q of the documents do not exceed."""
    return sums.where(F.col("share_up_to") >= q).agg(F.min("n_tokens").alias("n_tokens"))
