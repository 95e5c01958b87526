"""Evaluate expensive columns once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, keep: list[str] | tuple[str, ...], columns: dict[str, Column | str]) -> DataFrame:
    """``keep`` and the computed columns (Columns or SQL texts), each as a stored value of the row.

    The optimizer moves a later filter below a projection and repeats the projection's
    expressions in it, so a column of JSON look-ups that feeds a filter and a result would run
    several times per row. A generator of one row is not crossed by filters on its output.
    """
    # Computed by a projection (compiled code, shared sub-expressions), then passed through.
    computed = df.select(*keep, *[(F.expr(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])
    return computed.select(*keep, F.inline(F.array(F.struct(*columns))))
