"""Row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: str) -> Column:
    """md5 over the parts as text, joined with ``-``; NULL has its own marker, so it differs from ''."""
    texts = [F.coalesce(F.col(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def slug_or_track(slug: Column, track: Column) -> Column:
    """The slug, or the track name where the slug is missing or empty."""
    return F.coalesce(F.when(slug != "", slug), track)


def track_code(track: Column, mapped: Column) -> Column:
    """Mapped code, else the first three characters in upper case."""
    return F.coalesce(mapped, F.upper(F.substring(track, 1, 3)))


def two_digits(number: Column) -> Column:
    """Zero-padded to two digits. Longer numbers stay whole (lpad alone would cut them)."""
    text = number.cast("string")
    return F.when(F.length(text) >= 2, text).otherwise(F.lpad(text, 2, "0"))


def meeting_id(code: Column, day: Column) -> Column:
    """Track code and ddMMyyyy."""
    return F.concat(code, F.date_format(day, "ddMMyyyy"))


def race_id(code: Column, day: Column, number: Column) -> Column:
    """Meeting id and race number."""
    return F.concat(meeting_id(code, day), two_digits(number))
