"""Numbering rows without putting a hot group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a group that one task numbers, about.
BLOCK = 1 << 20
# Rows of a block that are picked to place its cut, about.
PICKED = 16

# Every PICKED-th of some sorted ids, and the powers of two up to their number, largest first: the steps of a bisection.
_CUTS = f"filter({{ids}}, (x, n) -> n > 0 AND n % {PICKED} = 0)"
_STEPS = "filter(transform(sequence(30, 0, -1), b -> shiftleft(1, b)), s -> s <= size({at}))"
# How many cuts lie below a value: one comparison for each step.
_BELOW = "aggregate({steps}, 0, (p, s) -> if(coalesce(get({at}, p + s - 1) < {value}, false), p + s, p))"


def number_rows(df: DataFrame, key: str, day: str, row_id: str, output: str, block: int = BLOCK) -> DataFrame:
    """``row_number() over (partition by key order by day, row_id)`` for groups of any size and ids of any orderable type.

    ``row_id`` is unique. A key with more than about ``block`` rows is cut into blocks of about that many at (day, id)
    pairs taken from the data: of a sample by the hash of the id, the same in every run, every ``PICKED``-th is a cut.
    Each row finds its block by bisection, so it takes log2(cuts) comparisons. Rows are dealt by (key, block), as one
    value: else rows that lie by key already would stay so, a hot key in one task. They are numbered there and shifted by
    the counts of the blocks before; where the number is not read, they stay. Cuts and block counts, about rows / block of
    them, are broadcast, so that no look-up shuffles the rows. All keys take this one path; where no key has a cut, as
    the adaptive planner sees when the sample is done, both look-ups are empty and drop out of the plan.
    """
    columns = ", ".join(f"r.`{c}`" for c in df.columns)
    at = f"named_struct('d', `{day}`, 'i', `{row_id}`)"
    return df.sparkSession.sql(
        f"""
        WITH picked AS (
            SELECT `{key}` AS k, sort_array(collect_list({at})) AS ids
            FROM {{rows}} WHERE pmod(xxhash64(`{row_id}`), {max(1, block // PICKED)}) = 0 GROUP BY ALL HAVING count(*) > {PICKED}
        ), cuts AS (
            SELECT k, at, {_STEPS.format(at="at")} AS steps FROM (SELECT k, {_CUTS.format(ids="ids")} AS at FROM picked)
        ), placed AS (
            SELECT /*+ BROADCAST(cuts) */ r.*, at IS NOT NULL AS _cut, coalesce({_BELOW.format(steps="steps", at="at", value=at)}, 0) AS _block
            FROM {{rows}} r LEFT JOIN cuts ON r.`{key}` <=> k
        ), local AS (
            SELECT *, row_number() OVER (PARTITION BY named_struct('k', `{key}`, 'b', _block) ORDER BY `{day}`, `{row_id}`) AS _n FROM placed
        ), shift AS (
            SELECT k, b, sum(n) OVER (PARTITION BY k ORDER BY b) - n AS rows_before
            FROM (SELECT `{key}` AS k, _block AS b, count(*) AS n FROM placed WHERE _cut GROUP BY ALL)
        )
        SELECT /*+ BROADCAST(s) */ {columns}, CAST(r._n + coalesce(s.rows_before, 0) AS BIGINT) AS `{output}`
        FROM local r LEFT JOIN shift s ON r.`{key}` <=> s.k AND r._block = s.b
        """,
        rows=df,
    )


def number_by_position(df: DataFrame, position: str, output: str, block: int = BLOCK) -> DataFrame:
    """Zero-based number of each row in the order of ``position``, which is unique.

    A global ``row_number`` would sort all rows in one task. Here the rows are cut as above; the cuts, one for each
    ``block`` rows, reach the tasks as the value of a subquery, so the look-up is no join and a row is shuffled once.
    Only the block counts, rows / block of them, meet in one place.
    """
    columns = ", ".join(f"r.`{c}`" for c in df.columns)
    return df.sparkSession.sql(
        f"""
        WITH cuts AS (
            SELECT {_CUTS.format(ids="ids")} AS at
            FROM (SELECT sort_array(collect_list(`{position}`)) AS ids FROM {{rows}} WHERE pmod(xxhash64(`{position}`), {max(1, block // PICKED)}) = 0)
        ), known AS (
            SELECT r.*, (SELECT named_struct('at', at, 'steps', {_STEPS.format(at="at")}) FROM cuts) AS _c FROM {{rows}} r
        ), placed AS (
            SELECT *, {_BELOW.format(steps="_c.steps", at="_c.at", value=f"`{position}`")} AS _block FROM known
        ), local AS (
            SELECT *, row_number() OVER (PARTITION BY _block ORDER BY `{position}`) AS _n
            FROM (SELECT /*+ REPARTITION(_block) */ {columns}, _block FROM placed r)
        ), shift AS (
            SELECT b, sum(n) OVER (ORDER BY b) - n AS rows_before FROM (SELECT _block AS b, count(*) AS n FROM placed GROUP BY ALL)
        )
        SELECT {columns}, CAST(r._n + s.rows_before - 1 AS BIGINT) AS `{output}` FROM local r JOIN shift s ON r._block = s.b
        """,
        rows=df,
    )


def batch_number(index: Column, size: int) -> Column:
    """Zero-based batch of a zero-based row index."""
    return F.floor(index / F.lit(size)).cast("bigint")
