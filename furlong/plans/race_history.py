"""Race history: landed form responses to keyed race rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions.gate import is_object
from furlong.functions.keys import meeting_id, race_id, slug_or_track, track_code
from furlong.functions.parsing import distance_meters, prize_total, unreadable
from furlong.functions.tracks import with_mapped_code
from furlong.operators.keyed import first_per_key
from furlong.operators.stage import compute_once
from furlong.schemas import RACE
from furlong.sources.landing import forms, meetings

# Fixed values.
RACE_STATUS = "completed"
SHORT_NAME_LENGTH = 100

_MEETING = ["meeting_date", "track"]


def first_failures(responses: DataFrame) -> DataFrame:
    """Lowest race number per (date, track) that did not answer 200 (no status counts as none). Meetings without one have no row."""
    failed = responses.where(~F.col("http_status").eqNullSafe(200))
    return failed.groupBy(*_MEETING).agg(F.min("race_num").alias("first_failure"))


def before_failure(read: DataFrame, failures: DataFrame) -> DataFrame:
    """Rows below the first failed race number of their meeting.

    Failures are few and counted before the shuffle. A window per meeting would gather a whole
    meeting in one task; a join lets the planner split a hot one.
    """
    below = F.col("first_failure").isNull() | (F.col("race_num") < F.col("first_failure"))
    return read.join(failures, _MEETING, "left").where(below).select(*read.columns)


def answered(responses: DataFrame) -> DataFrame:
    return responses.where(F.col("http_status") == 200)


def answered_prefix(responses: DataFrame) -> DataFrame:
    """Responses that a reader gets who asks for races 1, 2, ... and stops at the first failure."""
    return before_failure(answered(responses), first_failures(responses))


def race_rejects(responses: DataFrame) -> DataFrame:
    """Answered forms that make no race row: the body or a field does not parse, or the course is not given."""
    return parse_forms(answered_prefix(responses)).where("NOT valid OR track IS NULL")


def _kind(name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get("form", f"$.{name}", "variant"))


def _text(name: str) -> Column:
    return F.try_variant_get("form", f"$.{name}", "string")


def _scalar(kind: Column) -> Column:
    return ~(kind.startswith("OBJECT") | kind.startswith("ARRAY"))


def _empty_or_text(kind: Column, text: Column) -> Column:
    """Text fields that get parsed: a string, or something that counts as not given."""
    empty = text.isin("0", "false", "[]", "{}")
    return (kind == "STRING") | (kind == "VOID") | empty


def parse_forms(responses: DataFrame) -> DataFrame:
    """Typed columns of each form and ``valid``.

    Not valid: a body that is no JSON object, a name that is null or no string, a prize, distance,
    date or field size that is there but does not parse. A missing name is fine.
    """
    kinds = {
        "name": _kind("raceName"), "prize": _kind("prizeMoney"), "distance": _kind("distance"),
        "class": _kind("raceClass"), "date": _kind("date"), "condition": _kind("condition"),
        "field": _kind("numberOfRunners"),
    }
    keep = [c for c in responses.columns if c != "body"]
    texts = compute_once(forms(responses), keep, {
        "_object": is_object("form"),
        **{f"_k_{n}": kind for n, kind in kinds.items()},
        "race_name": _text("raceName"),
        "_prize": _text("prizeMoney"),
        "_distance": _text("distance"),
        "race_class": _text("raceClass"),
        "_date": _text("date"),
        "race_condition": _text("condition"),
        "_field": _text("numberOfRunners"),
    })
    given = lambda n, c: F.when(F.col(f"_k_{n}") == "STRING", F.col(c))
    prize, distance = given("prize", "_prize"), given("distance", "_distance")
    day, field = F.col("_date").try_cast("date"), F.col("_field").try_cast("int")
    valid = (
        F.col("_object")
        & (F.col("_k_name").isNull() | (F.col("_k_name") == "STRING"))
        & F.coalesce(_empty_or_text(F.col("_k_prize"), F.col("_prize")), F.lit(True))
        & ~F.coalesce(unreadable(prize, prize_total(prize)), F.lit(False))
        & F.coalesce(_empty_or_text(F.col("_k_distance"), F.col("_distance")), F.lit(True))
        & ~F.coalesce(unreadable(distance, distance_meters(distance)), F.lit(False))
        & (F.col("_date").isNull() | day.isNotNull())
        & (F.col("_field").isNull() | field.isNotNull())
        & F.coalesce(_scalar(F.col("_k_class")), F.lit(True))
        & F.coalesce(_scalar(F.col("_k_condition")), F.lit(True))
    )
    return texts.select(
        *keep,
        "race_name",
        F.left(F.coalesce("race_name", F.lit("")), F.lit(SHORT_NAME_LENGTH)).alias("short_race_name"),
        "race_class",
        day.alias("scheduled_date"),
        distance_meters(distance).alias("distance_meters"),
        "race_condition",
        field.alias("field_size"),
        prize_total(prize).alias("prize_total"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
    )


def _race_columns(now: Column) -> list[Column]:
    code = track_code(F.col("track"), F.col("mapped_code"))
    day = F.col("meeting_date")
    return [
        race_id(code, day, F.col("race_num")).alias("race_id"),
        F.col("race_name"),
        F.col("short_race_name"),
        meeting_id(code, day).alias("meeting_id"),
        F.col("track").alias("venue"),
        F.col("race_num").alias("race_order"),
        F.col("race_class"),
        F.col("scheduled_date"),
        F.lit(RACE_STATUS).alias("race_status"),
        F.col("distance_meters"),
        F.col("race_condition"),
        F.col("field_size"),
        F.col("prize_total"),
        now.alias("record_created_date"),
        now.alias("extracted_at"),
        F.col("meeting_date"),
        F.col("arrival"),
    ]


def race_rows(responses: DataFrame, tracks: DataFrame, now: Column) -> DataFrame:
    """Race rows of all readable responses, with ``meeting_date`` and ``arrival``; keys may repeat."""
    # Parsed before the join: a few columns travel, not the response bodies.
    read = parse_forms(answered(responses)).where("valid and track is not null")
    parsed = before_failure(read, first_failures(responses))
    return with_mapped_code(parsed, tracks).select(*_race_columns(now))


def attempted_rows(responses: DataFrame, tracks: DataFrame, now: Column) -> DataFrame:
    """Race rows of all answered forms, ``good`` false for those that make none (`race_rejects`)."""
    parsed = before_failure(parse_forms(answered(responses)), first_failures(responses))
    good = F.coalesce(F.col("valid"), F.lit(False)) & F.col("track").isNotNull()
    return with_mapped_code(parsed, tracks).select(*_race_columns(now), good.alias("good"))


def race_history(responses: DataFrame, tracks: DataFrame, now: Column) -> DataFrame:
    """One row per race id: the first response that arrived for it."""
    rows = race_rows(responses, tracks, now)
    return first_per_key(rows, ["race_id"], [F.asc("arrival")]).select(*RACE.names)


def race_audit(responses: DataFrame, tracks: DataFrame, now: Column) -> DataFrame:
    """One row: forms attempted, and of them inserted, ignored (their race id was there) and rejected."""
    # The forms are parsed once; ids and rejects are counted in the same pass.
    parsed = parse_forms(answered_prefix(responses))
    code = track_code(F.col("track"), F.col("mapped_code"))
    good = F.col("valid") & F.col("track").isNotNull()
    key = F.when(good, race_id(code, F.col("meeting_date"), F.col("race_num")))
    per_id = with_mapped_code(parsed, tracks).groupBy(key.alias("race_id")).agg(F.count(F.lit(1)).alias("n"))
    counts = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("attempted"), F.count("race_id").alias("inserted"),
        F.coalesce(F.sum(F.when(F.col("race_id").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("ignored"),
        F.coalesce(F.sum(F.when(F.col("race_id").isNull(), F.col("n"))), F.lit(0)).alias("rejected"),
    )
    return counts


def request_plan(meeting_responses: DataFrame, races_per_meeting: int, days: DataFrame | None = None) -> DataFrame:
    """Requests to make: each meeting of each answered date, races 1 to ``races_per_meeting``; with ``days`` (column ``day``), of those days."""
    held = meetings(meeting_responses)
    if days is not None:
        held = held.join(days, F.col("meeting_date") == F.col("day"), "left_semi")
    return held.select(
        "meeting_date",
        slug_or_track(F.col("slug"), F.col("track")).alias("track"),
        F.explode(F.sequence(F.lit(1), F.lit(races_per_meeting))).alias("race_num"),
    )
