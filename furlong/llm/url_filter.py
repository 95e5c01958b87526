"""URL filters by a temporal list join, in DataFrame operations only.

Dated list entries (add or remove a host or domain) become validity intervals. A capture is evaluated against the entries
that are active when it was fetched: an as-of join, made an equi-join on the pattern with a range check. Captures are first folded to
distinct (host, fetch time), so a host that holds a third of all captures is looked up once per fetch time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "9999-12-31 00:00:00"


def host_of(url: str) -> Column:
    """Lower-case host of a URL column, without user, port and final dots; empty where there is none.

    An IPv6 address keeps its brackets. What stands before the last @ of the authority is user information.
    """
    authority = F.regexp_extract(F.lower(F.trim(F.coalesce(F.col(url), F.lit("")))), r"^[a-z][a-z0-9+.-]*://([^/?#\\\\]*)", 1)
    return F.regexp_extract(F.regexp_replace(authority, "^.*@", ""), r"^(\[[^\]]*\]|[^:]*?)\.*(?::.*)?$", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """`pattern`, `valid_from`, `valid_to` (exclusive) from `pattern`, `action` (add or remove), `at`.

    An addition holds until the next removal. Of entries of one pattern and time, an addition wins; further additions and
    removals of what is not listed change nothing; rows with a null in any of the three are left out.
    """
    known = entries.where("pattern is not null and at is not null and action in ('add', 'remove')")
    once = known.groupBy("pattern", "at").agg(F.min("action").alias("action"))
    order = Window.partitionBy("pattern").orderBy("at")
    changes = once.withColumn("before", F.lag("action", 1, "remove").over(order)).where("action <> before")
    to = F.coalesce(F.lead("at").over(order), F.lit(END).cast("timestamp"))
    return changes.withColumn("valid_to", to).where("action = 'add'").select("pattern", F.col("at").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """The captures with `host`, `blocked`, and of the longest pattern that is active at fetch time `pattern` and `listed_at`.

    A pattern matches its own host and all hosts below it. Captures without a host or fetch time are not blocked. All
    rows and columns of captures stay; a column of the four names is replaced.
    """
    own = captures.drop("host", "blocked", "pattern", "listed_at").withColumn("host", host_of(url))
    asked = own.select("host", F.col(fetched).alias("_at")).where("host <> '' and _at is not null").distinct()
    # An address has no domains above it.
    labels = F.when(F.col("host").rlike(r"^(\[.*|[0-9]+(\.[0-9]+){3})$"), F.array("host")).otherwise(F.split("host", r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keyed = asked.select("host", "_at", F.explode(suffixes).alias("pattern"))
    active = keyed.join(intervals(entries), "pattern").where("_at >= valid_from and _at < valid_to")
    length = F.length("pattern")
    verdict = active.groupBy("host", "_at").agg(F.max_by("pattern", length).alias("pattern"), F.max_by("valid_from", length).alias("listed_at"))
    joined = own.withColumn("_at", F.col(fetched)).join(verdict, ["host", "_at"], "left").drop("_at")
    return joined.withColumn("blocked", F.col("pattern").isNotNull())
