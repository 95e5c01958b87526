"""Column functions on edge values."""

from __future__ import annotations

import datetime as dt
from datetime import date, datetime, timezone
from decimal import Decimal
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from furlong.functions import dates, keys, money, parsing, predicates
from furlong.functions.tracks import TRACK_CODES, tracks_table, with_mapped_code
from tests.conftest import rows


def values(spark, ddl, data, column):
    df = spark.createDataFrame(data, ddl)
    return [r[0] for r in df.select(column).collect()]


def one_column(spark, dtype, data, function):
    indexed = spark.createDataFrame(list(enumerate(data)), f"i int, v {dtype}")
    return [r[1] for r in sorted(indexed.select("i", function(F.col("v"))).collect())]


def test_cents_are_exact_decimals(spark):
    assert one_column(spark, "bigint", [1, 450, 12345, None, -7], money.cents_to_dollars) == [
        Decimal("0.01"), Decimal("4.50"), Decimal("123.45"), None, Decimal("-0.07"),
    ]


@pytest.mark.parametrize("variant", ["default", "spark", "postgres", "bigquery", "fabric"])
def test_cents_variants_agree_in_value(spark, variant):
    got = one_column(spark, "bigint", [1, 99, 100, 12345], lambda c: money.cents_to_dollars(c, variant))
    assert [float(v) for v in got] == [0.01, 0.99, 1.0, 123.45]


def test_unknown_cents_variant(spark):
    with pytest.raises(ValueError):
        money.cents_to_dollars("subtotal", "other")


def test_prize(spark):
    texts = ["$1,250,000", "", None, "N/A", " $5 ", "1_000", "1.5d", "$", "0x10", "1e3"]
    assert one_column(spark, "string", texts, parsing.prize_total) == [
        1250000.0, None, None, None, 5.0, 1000.0, None, None, None, 1000.0,
    ]
    bad = one_column(spark, "string", texts, lambda c: parsing.unreadable(c, parsing.prize_total(c)))
    assert [bool(b) for b in bad] == [False, False, False, True, False, False, True, True, True, False]


def test_distance(spark):
    texts = ["1400m", "1400 metres", " 1400m ", "mm12m", "1_400m", "1400.0m", "9999999999m", None, ""]
    assert one_column(spark, "string", texts, parsing.distance_meters) == [
        1400, None, 1400, 12, 1400, None, None, None, None,
    ]


_number_text = st.text(alphabet="0123456789._+-eE dfm", max_size=8)


@settings(max_examples=4, deadline=None)
@given(st.lists(_number_text, min_size=50, max_size=80))
def test_numbers_read_as_python_reads_them(spark, texts):
    def python(cast, text):
        try:
            return cast(text)
        except ValueError:
            return None

    assert one_column(spark, "string", texts, parsing.float_from_text) == [python(float, t) for t in texts]
    expected = [python(int, t) for t in texts]
    assert one_column(spark, "string", texts, parsing.int_from_text) == expected


def test_race_id_pads_but_never_cuts(spark):
    got = one_column(spark, "int", [7, 10, 107], lambda c: keys.race_id(F.lit("FLM"), F.lit(date(2025, 1, 15)), c))
    assert got == ["FLM1501202507", "FLM1501202510", "FLM15012025107"]
    assert one_column(spark, "int", [1], lambda c: keys.meeting_id(F.lit("FLM"), F.lit(date(2025, 1, 15)))) == ["FLM15012025"]


def test_track_codes(spark):
    assert len(TRACK_CODES) == 103 and len(set(TRACK_CODES.values())) == 103
    df = spark.createDataFrame([("Flemington",), ("flemington",), ("benalla",), ("ab",), (None,)], "track string")
    coded = with_mapped_code(df, tracks_table(spark)).select("track", keys.track_code(F.col("track"), F.col("mapped_code")).alias("code"))
    assert rows(coded) == sorted(
        [("Flemington", "FLM"), ("flemington", "FLM"), ("benalla", "BEN"), ("ab", "AB"), (None, None)], key=str
    )


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    got = {r[0] for r in df.select(keys.surrogate_key("x", "y")).collect()}
    assert len(got) == 3 and all(len(k) == 32 for k in got)


def test_slug_or_track(spark):
    df = spark.createDataFrame([("s", "t"), ("", "t"), (None, "t"), (None, None)], "s string, t string")
    assert [r[0] for r in df.select(keys.slug_or_track(F.col("s"), F.col("t"))).collect()] == ["s", "t", "t", None]


# Sydney: 25 hours on 2026-04-05, 23 hours on 2026-10-04.
@pytest.mark.parametrize("day", [date(2026, 4, 5), date(2026, 10, 4), date(2026, 1, 1), date(2026, 7, 1)])
def test_local_day_window(spark, day):
    zone = ZoneInfo(dates.ZONE)
    start = datetime(day.year, day.month, day.day, tzinfo=zone)
    expected = tuple(t.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") for t in (start, start.replace(hour=23, minute=59, second=59)))
    c = F.lit(day)
    got = spark.range(1).select(dates.instant_text(dates.window_start_utc(c)), dates.instant_text(dates.window_end_utc(c))).first()
    assert tuple(got) == expected


def test_start_inside_local_day(spark):
    texts = ["2026-04-30T14:00:00.000Z", "2026-04-30T13:59:59.999Z", "2026-05-01T13:59:59.000Z", "2026-05-01T14:00:00Z", "soon", None]
    got = one_column(spark, "string", texts, lambda c: dates.starts_within_day(c, F.lit(date(2026, 5, 1))))
    assert got == [True, False, True, False, None, None]


def test_date_argument(spark):
    assert one_column(spark, "string", ["2026-05-01", "2026-13-01", "x", "2026-05-01T10"], dates.day_from_argument) == [
        date(2026, 5, 1), None, None, date(2026, 5, 1),
    ]


def test_date_spine_has_366_days(spark):
    last = spark.sql("SELECT DATE '2026-05-01' AS d")
    days = [r[0] for r in dates.date_spine(last).collect()]
    assert len(days) == 366 and min(days) == date(2025, 5, 1) and max(days) == date(2026, 5, 1)
    assert dates.spine_to_today(spark).count() == 366


def test_run_stamp(spark):
    now = datetime(2026, 5, 1, 2, 30)
    assert one_column(spark, "timestamp", [now], dates.run_time_stamp) == ["12-30"]
    assert one_column(spark, "timestamp", [datetime(2026, 4, 30, 15, 0)], dates.local_day) == [date(2026, 5, 1)]


def test_flags(spark):
    assert one_column(spark, "string", ["jaffle", "x", None], lambda c: predicates.is_type(c, "jaffle")) == [True, False, False]
    assert one_column(spark, "boolean", [True, False, None], predicates.customer_type) == ["returning", "new", "new"]
    assert one_column(spark, "boolean", [True, False, None], predicates.not_scratched) == [False, True, None]
    assert one_column(spark, "boolean", [True, False, None], predicates.flag_to_int) == [1, 0, 0]
    assert dt.timedelta(0) == dt.timedelta()
