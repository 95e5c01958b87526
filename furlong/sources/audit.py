"""Run audit: how many records went through and how many did not."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from furlong.functions.gate import passes


def run_counts(gated: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Accepted and rejected records per run. Counted in the map tasks, one row per run and task moves."""
    return gated.groupBy(*keys).agg(
        F.count_if(passes()).alias("success"), F.count_if(~passes()).alias("failed")
    )


def observed(counted: Observation) -> int | None:
    """The number observed as ``n``; None where the planner found the branch empty and measured nothing."""
    try:
        return counted.get["n"]
    except Py4JJavaError as e:
        # An observation without a value is a row without a schema, which the conversion to Python asserts.
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return None
