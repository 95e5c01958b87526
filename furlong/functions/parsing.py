"""Number parsing for dirty text.

The grammar is the one Python's ``float()`` and ``int()`` use: blanks around the number
and single underscores between digits are fine. A plain Spark cast differs in both
directions (it takes ``1.5d`` and refuses ``1_000``), hence the patterns. Every parser
gives NULL for text it cannot read; callers turn "text there, number not" into a reject.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = r"[0-9]+(_[0-9]+)*"
FLOAT_PATTERN = (
    rf"(?i)^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf(inity)?|nan)\s*$"
)
INT_PATTERN = rf"^\s*[+-]?{_DIGITS}\s*$"
# Whole number, with or without a fraction of zeros.
INTEGRAL_PATTERN = rf"^\s*[+-]?{_DIGITS}(\.0*)?\s*$"

ZERO_FRACTION = r"\.0*\s*$"
# What may stand in a number's text without being part of it.
BLANKS = r"[_\s]"


def float_from_text(text: Column) -> Column:
    bare = F.regexp_replace(text, BLANKS, "")
    return F.when(text.rlike(FLOAT_PATTERN), bare.try_cast("double"))


def int_from_text(text: Column, dtype: str = "int") -> Column:
    bare = F.regexp_replace(text, BLANKS, "")
    return F.when(text.rlike(INT_PATTERN), bare.try_cast(dtype))


def prize_total(text: Column) -> Column:
    """``$1,250,000`` -> 1250000.0. Empty or missing gives NULL."""
    return float_from_text(F.replace(F.replace(text, F.lit("$"), F.lit("")), F.lit(","), F.lit("")))


def distance_meters(text: Column) -> Column:
    """``1400m`` -> 1400. Every ``m`` goes, so ``1400 metres`` is not a distance."""
    return int_from_text(F.replace(text, F.lit("m"), F.lit("")))


def unreadable(text: Column, parsed: Column) -> Column:
    """True where there is text, it is not empty, and it did not parse."""
    return text.isNotNull() & (text != "") & parsed.isNull()


def none_if_empty(text: Column) -> Column:
    return F.when(text != "", text)
