"""Cents to dollars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"


def cents_to_dollars(cents: Column | str, variant: str = "default") -> Column:
    """Integer cents as dollars.

    ``default`` is exact decimal(16,2). The other variants keep the rounding and the
    result type that the same macro has on other warehouses:

    ``spark``     round(cents / 100, 2), a double
    ``postgres``  cast first, then divide; the quotient's scale is kept
    ``bigquery``  quotient cast to numeric(38,9), then rounded to 2 digits
    ``fabric``    quotient cast to numeric(16,2)
    """
    c = F.col(cents) if isinstance(cents, str) else cents
    quotient = c.cast("decimal(18,0)") / F.lit(100)
    if variant in ("default", "fabric"):
        return quotient.cast(MONEY)
    if variant == "spark":
        return F.round(c / F.lit(100), 2)
    if variant == "postgres":
        return c.cast(MONEY) / F.lit(100)
    if variant == "bigquery":
        return F.round(quotient.cast("decimal(38,9)"), 2)
    raise ValueError(f"unknown variant: {variant}")
