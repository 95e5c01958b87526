"""Join helpers.

No join here carries a broadcast hint except where the broadcast side is fixed or bounded by
construction. Lookups of unknown size are left to the planner: it broadcasts a side whose
size it knows to be small, at plan time or at run time, and sort-merges otherwise, splitting
hot partitions of the left side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows written for one descriptor when rows are repeated: the length of an inner array, and how far a task's output can
# outgrow its input.
CHUNK = 64


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times, without the count column.

    The planner's skew rules look at input bytes, and a few rows with large counts are small. So rows of more than
    ``CHUNK`` copies are folded (equal ones add up their counts), cut into descriptors of at most ``CHUNK`` copies, and
    dealt by row and chunk to as many tasks as the session plans for a shuffle; a number given here is not coalesced.
    Only descriptors travel; each is expanded where it arrives. Rows of fewer copies are expanded in place. Where no row
    has more, the adaptive planner drops that branch once the counts are known.
    """
    names, n = [c for c in df.columns if c != copies], F.col(copies)
    folded = df.where(n > CHUNK).groupBy(*names).agg(F.sum(copies).alias(copies))
    cut = folded.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / CHUNK))))
    dealt = cut.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *names, "_chunk")
    many = dealt.withColumn("_n", F.least(F.lit(CHUNK), n - F.col("_chunk") * CHUNK).cast("int"))
    few = df.where(n <= CHUNK).withColumn("_n", n.cast("int"))
    return few.select(*names, "_n").unionByName(many.select(*names, "_n")).withColumn("_copy", F.explode(F.sequence(F.lit(1), "_n"))).select(*names)


def lookup_pair(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Two lookup tables on the same key as one.

    Left-joining a fact to ``left`` and then to ``right`` gives the same rows as left-joining
    it to this one, since ``right`` has one row per key. The fact is shuffled at most once, and
    the planner can split a hot key of it, which it cannot do in a chain of joins on one key.
    """
    return left.join(right, key, "full")


def semi(df: DataFrame, ids: DataFrame, condition: Column) -> DataFrame:
    return df.join(ids, condition, "left_semi")
