"""Dates, race-day windows and run stamps.

Race days are wall-clock days in Sydney. Instants are UTC; sessions are expected to run
with ``spark.sql.session.timeZone=UTC`` (``furlong.session`` sets it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE = "Australia/Sydney"
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
RUN_TIME_FORMAT = "HH-mm"


def to_day(ts: Column) -> Column:
    """Timestamp to date; the time part is dropped, never rounded."""
    return ts.cast("date")


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def instant_text(ts: Column) -> Column:
    """UTC instant as ``2026-05-01T00:00:00Z``."""
    return F.date_format(ts, INSTANT_FORMAT)


def day_from_argument(text: Column) -> Column:
    """``YYYY-MM-DD`` text, by position: year, month and day digits. NULL if it is no date."""
    part = lambda start, length: F.substring(text, start, length).try_cast("int")
    iso = F.format_string("%04d-%02d-%02d", part(1, 4), part(6, 2), part(9, 2))
    return F.when(
        part(1, 4).isNotNull() & part(6, 2).isNotNull() & part(9, 2).isNotNull(),
        iso.try_cast("date"),
    )


def window_start_utc(day: Column, zone: str = ZONE) -> Column:
    """First instant of the local day."""
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def window_end_utc(day: Column, zone: str = ZONE) -> Column:
    """Last whole second of the local day. On a day with a clock change the local day is 23 or 25 h long."""
    last_second = day.cast("timestamp") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    return F.to_utc_timestamp(last_second, zone)


def starts_within_day(start_text: Column, day: Column, zone: str = ZONE) -> Column:
    """Start time (ISO text, UTC) inside the local race day, bounds included."""
    start = F.date_trunc("second", start_text.try_cast("timestamp"))
    return start.between(window_start_utc(day, zone), window_end_utc(day, zone))


def local_day(ts: Column, zone: str = ZONE) -> Column:
    """Local calendar day of a UTC instant."""
    return F.from_utc_timestamp(ts, zone).cast("date")


def run_time_stamp(now: Column, zone: str = ZONE) -> Column:
    """``HH-mm`` wall clock of a run."""
    return F.date_format(F.from_utc_timestamp(now, zone), RUN_TIME_FORMAT)


def date_spine(last_day: DataFrame, days_back: int = 365) -> DataFrame:
    """One row per day from ``days_back`` before the given day through that day.

    ``last_day`` is a one-column, one-row frame (a literal, ``current_date()`` or an
    aggregate such as ``max(order_date)``).
    """
    end = F.col(last_day.columns[0])
    return last_day.select(F.explode(F.sequence(F.date_sub(end, days_back), end)).alias("day"))


def spine_to_today(spark: SparkSession, days_back: int = 365) -> DataFrame:
    return date_spine(spark.range(1).select(F.current_date().alias("today")), days_back)
