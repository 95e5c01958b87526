"""Racing queries: Gold join, race history, request plan, and the scalar rules behind them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from furlong.functions import dates, keys, parsing
from furlong.functions.predicates import not_scratched
from furlong.functions.tracks import TRACK_CODES, tracks_table, with_mapped_code
from furlong.operators import keyed
from furlong.plans import race_history, race_run, racing
from furlong.plans.race_run import RacePaths
from furlong.registry.core import Inputs, registry
from furlong.schemas import RACE
from furlong.sources.keyed import insert_or_ignore, new_rows, read_keyed
from furlong.sources.landing import forms, meeting_rejects, meetings

model, add = registry.model, registry.add

NOW = "2026-05-01 02:30:00"


def now():
    return F.lit(NOW).cast("timestamp")


# ---------------------------------------------------------------- Silver and Gold
RACE_COLUMNS = "track race_number:l race_date:d race_name distance_m:l race_class track_condition"
RUNNER_COLUMNS = ("race_date:d track race_number:l horse_name jockey trainer barrier:l weight_kg:f "
                  "overall_starts:l overall_wins:l overall_win_pct:f")
GOLD = ("track race_number:l race_date:d race_name distance_m:l track_condition horse_name jockey trainer "
        "barrier:l weight_kg:f overall_win_pct:f")

model("m_races", "SELECT track, race_number, race_date, race_name, distance_m, race_class, track_condition FROM silver_runners")
model("m_runners", """SELECT race_date, track, race_number, horse_name, jockey, trainer, barrier, weight_kg,
    overall_starts, overall_wins, overall_win_pct FROM silver_runners WHERE scratched = FALSE""")
model("m_gold", """SELECT r.track, r.race_number, r.race_date, r.race_name, r.distance_m, r.track_condition,
    u.horse_name, u.jockey, u.trainer, u.barrier, u.weight_kg, u.overall_win_pct
    FROM m_races r JOIN m_runners u ON r.track = u.track AND r.race_number = u.race_number AND r.race_date = u.race_date""")


def gold(t: Inputs):
    silver = t("silver_runners")
    return racing.race_runners(racing.races(silver), racing.runners(silver))


add("p11_race_columns", RACE_COLUMNS, lambda t: racing.races(t("silver_runners")), "SELECT * FROM m_races")
add("p12_runner_columns", RUNNER_COLUMNS, lambda t: racing.runners(t("silver_runners")), "SELECT * FROM m_runners")
add("p13_gold_columns", GOLD, gold, "SELECT * FROM m_gold")
add("j1_race_runners", GOLD, gold, "SELECT * FROM m_gold")
add("race_runners_gold", GOLD, gold, "SELECT * FROM m_gold")
# The same join without the fan-out: equal race rows are a count.
add("race_runners_counted", f"{GOLD} copies:l", lambda t: racing.race_runners_counted(*(f(t("silver_runners")) for f in (racing.races, racing.runners))),
    "SELECT *, COUNT(*) AS copies FROM m_gold GROUP BY ALL")
add("f1_not_scratched", "horse_name barrier:l",
    lambda t: t("silver_runners").where(not_scratched(F.col("scratched"))),
    "SELECT horse_name, barrier FROM silver_runners WHERE scratched = FALSE")

# ---------------------------------------------------------------- responses
MEETINGS = "meeting_date:d slug track"
model("m_meetings", """SELECT meeting_date, m ->> '$.slug' AS slug, m ->> '$.track' AS track FROM (
    SELECT meeting_date, UNNEST(CAST(json_extract(body, '$.meetings') AS JSON[])) AS m
    FROM meetings_raw WHERE http_status = 200)""")
model("m_asked", "SELECT * FROM form_raw")
model("m_failures", "SELECT meeting_date, track, MIN(race_num) AS first_failure FROM m_asked WHERE http_status IS DISTINCT FROM 200 GROUP BY 1, 2")
model("m_prefix", """SELECT a.* FROM m_asked a LEFT JOIN m_failures f ON a.meeting_date = f.meeting_date AND a.track = f.track
    WHERE a.http_status = 200 AND (f.first_failure IS NULL OR a.race_num < f.first_failure)""")
model("m_forms", """SELECT meeting_date, track, race_num, arrival, json_type(j, '$') AS top,
    json_type(j, '$.raceName') AS name_type, j ->> '$.raceName' AS race_name, j ->> '$.prizeMoney' AS prize,
    j ->> '$.distance' AS distance, j ->> '$.raceClass' AS race_class, j ->> '$.date' AS day,
    j ->> '$.condition' AS race_condition, j ->> '$.numberOfRunners' AS field
    FROM (SELECT *, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM {source})""".replace("{source}", "m_prefix"))
model("m_parsed", """SELECT *, TRY_CAST(REPLACE(REPLACE(NULLIF(prize, ''), '$', ''), ',', '') AS DOUBLE) AS prize_total,
    TRY_CAST(REPLACE(NULLIF(distance, ''), 'm', '') AS INTEGER) AS distance_meters FROM m_forms""")
model("m_valid", """SELECT * FROM m_parsed WHERE top = 'OBJECT' AND track IS NOT NULL AND (name_type IS NULL OR name_type = 'VARCHAR')
    AND NOT (COALESCE(prize, '') <> '' AND prize_total IS NULL)
    AND NOT (COALESCE(distance, '') <> '' AND distance_meters IS NULL)""")
model("m_tracks", "SELECT slug, code FROM (VALUES " + ", ".join(f"('{s}', '{c}')" for s, c in TRACK_CODES.items()) + ") AS v(slug, code)")
model("m_race_rows", """SELECT c.code || strftime(meeting_date, '%d%m%Y') || CASE WHEN race_num < 10 THEN '0' ELSE '' END || race_num AS race_id,
    race_name, SUBSTR(COALESCE(race_name, ''), 1, 100) AS short_race_name,
    c.code || strftime(meeting_date, '%d%m%Y') AS meeting_id, track AS venue, race_num AS race_order, race_class,
    CAST(day AS DATE) AS scheduled_date, 'completed' AS race_status, distance_meters, race_condition,
    CAST(field AS INTEGER) AS field_size, prize_total, meeting_date, arrival
    FROM (SELECT v.*, COALESCE(k.code, UPPER(SUBSTR(v.track, 1, 3))) AS code
          FROM m_valid v LEFT JOIN m_tracks k ON LOWER(v.track) = k.slug) c""")
model("m_history_rows", f"""SELECT *, TIMESTAMP '{NOW}' AS record_created_date, TIMESTAMP '{NOW}' AS extracted_at
    FROM m_race_rows QUALIFY ROW_NUMBER() OVER (PARTITION BY race_id ORDER BY arrival) = 1""")

RACE_ROW = ("race_id race_name short_race_name meeting_id venue race_order:l race_class scheduled_date:d race_status "
            "distance_meters:l race_condition field_size:l prize_total:f")
RACE_TABLE = f"{RACE_ROW} record_created_date:t extracted_at:t"


def rows(t: Inputs):
    return race_history.race_rows(t("form_raw"), tracks_table(t.spark), now())


add("race_history", RACE_TABLE, lambda t: race_history.race_history(t("form_raw"), tracks_table(t.spark), now()),
    "SELECT * FROM m_history_rows")
add("s8_meetings", MEETINGS, lambda t: meetings(t("meetings_raw")), "SELECT * FROM m_meetings")
add("s9_forms", "meeting_date:d track race_num:l http_status:l is_json:b race_class",
    lambda t: forms(t("form_raw")).select(
        "meeting_date", "track", "race_num", "http_status", F.col("form").isNotNull().alias("is_json"),
        F.try_variant_get("form", "$.raceClass", "string").alias("race_class")),
    """SELECT meeting_date, track, race_num, http_status, json_valid(body) AS is_json,
       CASE WHEN json_valid(body) THEN body ->> '$.raceClass' END AS race_class FROM form_raw""")
add("f8_prefix_of_races", "meeting_date:d track race_num:l arrival:l",
    lambda t: race_history.answered_prefix(t("form_raw")), "SELECT * FROM m_prefix")
add("w2_first_failure", "meeting_date:d track first_failure:l",
    lambda t: race_history.first_failures(t("form_raw")), "SELECT * FROM m_failures")
add("f9_answered_dates", "meeting_date:d body",
    lambda t: t("meetings_raw").where("http_status = 200"), "SELECT meeting_date, body FROM meetings_raw WHERE http_status = 200")
add("f10_unparsable_rows", "meeting_date:d track race_num:l arrival:l",
    lambda t: race_history.race_rejects(t("form_raw")),
    "SELECT * FROM m_prefix WHERE arrival NOT IN (SELECT arrival FROM m_valid)")
add("race_audit", "attempted:l inserted:l ignored:l rejected:l",
    lambda t: race_history.race_audit(t("form_raw"), tracks_table(t.spark), now()),
    """SELECT *, attempted - inserted - rejected AS ignored FROM (
       SELECT (SELECT COUNT(*) FROM m_prefix) AS attempted, (SELECT COUNT(*) FROM m_history_rows) AS inserted,
              (SELECT COUNT(*) FROM m_prefix WHERE arrival NOT IN (SELECT arrival FROM m_valid)) AS rejected)""")


def stored_history(t: Inputs) -> tuple[RacePaths, str]:
    """Meetings of even days of the year first, then all of them, and that run again as after a failure."""
    root = t.scratch()
    paths = RacePaths(f"{root}/races", f"{root}/attempts", f"{root}/audit")
    for run_id, part in (("even", t("form_raw").where("dayofyear(meeting_date) % 2 = 0")), ("all", t("form_raw")), ("all", t("form_raw"))):
        race_run.run_history(part, tracks_table(t.spark), paths, run_id, now())
    return paths, "all"


model("m_attempts", """SELECT meeting_date, 1 AS attempted, 0 AS inserted, 0 AS rejected FROM m_prefix
    UNION ALL SELECT meeting_date, 0, 1, 0 FROM m_history_rows
    UNION ALL SELECT meeting_date, 0, 0, 1 FROM m_prefix WHERE arrival NOT IN (SELECT arrival FROM m_valid)""")
add("race_run_counts", "run_id attempted:l inserted:l ignored:l rejected:l",
    lambda t: race_run.read_counts(t.spark, stored_history(t)[0].audit),
    """SELECT *, attempted - inserted - rejected AS ignored FROM (
       SELECT 'even' AS run_id, SUM(attempted) AS attempted, SUM(inserted) AS inserted, SUM(rejected) AS rejected
       FROM m_attempts WHERE dayofyear(meeting_date) % 2 = 0
       UNION ALL SELECT 'all', SUM(attempted), COALESCE(SUM(inserted) FILTER (dayofyear(meeting_date) % 2 = 1), 0), SUM(rejected) FROM m_attempts)""")
add("race_run_races", f"{RACE_TABLE} run_id", lambda t: race_run.read_races(t.spark, stored_history(t)[0].races),
    "SELECT *, CASE WHEN dayofyear(meeting_date) % 2 = 0 THEN 'even' ELSE 'all' END AS run_id FROM m_history_rows")
add("race_run_rejects", "meeting_date:d venue race_order:l arrival:l",
    lambda t: (lambda s: race_run.read_rejects(t.spark, s[0].attempts, s[1]))(stored_history(t)),
    "SELECT meeting_date, track AS venue, race_num AS race_order, arrival FROM m_prefix WHERE arrival NOT IN (SELECT arrival FROM m_valid)")
add("p14_race_row", f"{RACE_ROW} arrival:l", rows, "SELECT * FROM m_race_rows")
add("p15_constant_status", "race_id race_status arrival:l", rows, "SELECT * FROM m_race_rows")
add("p16_load_timestamps", "race_id record_created_date:t extracted_at:t",
    lambda t: race_history.race_history(t("form_raw"), tracks_table(t.spark), now()), "SELECT * FROM m_history_rows")
add("j7_track_code", "track code arrival:l",
    lambda t: with_mapped_code(t("form_raw"), tracks_table(t.spark)).withColumn("code", keys.track_code(F.col("track"), F.col("mapped_code"))),
    """SELECT track, COALESCE(k.code, UPPER(SUBSTR(track, 1, 3))) AS code, arrival
       FROM form_raw LEFT JOIN m_tracks k ON LOWER(track) = k.slug""")
add("w3_first_writer", "race_id venue arrival:l",
    lambda t: keyed.first_per_key(rows(t), ["race_id"], [F.asc("arrival")]), "SELECT * FROM m_history_rows")

# The table already holds what arrived on even numbers; then everything is offered.
model("m_even", "SELECT * FROM m_race_rows WHERE arrival % 2 = 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY race_id ORDER BY arrival) = 1")
add("j8_not_in_target", "race_id venue arrival:l",
    lambda t: new_rows(rows(t), keyed.first_per_key(rows(t).where("arrival % 2 = 0"), ["race_id"], [F.asc("arrival")]),
                       "race_id", [F.asc("arrival")], partition="meeting_date"),
    "SELECT * FROM m_history_rows WHERE race_id NOT IN (SELECT race_id FROM m_even)")


def inserted_twice(t: Inputs):
    """Even arrivals first, then all of them; the second run must only add ids that are new."""
    path = t.scratch()
    for batch in (rows(t).where("arrival % 2 = 0"), rows(t)):
        insert_or_ignore(batch, path, "race_id", [F.asc("arrival")], partition="meeting_date")
    return read_keyed(t.spark, path, rows(t).schema)


add("s10_insert_or_ignore", f"{RACE_ROW} arrival:l", inserted_twice,
    "SELECT * FROM m_even UNION ALL SELECT * EXCLUDE (record_created_date, extracted_at) FROM m_history_rows WHERE race_id NOT IN (SELECT race_id FROM m_even)")



def inserted_at_once(t: Inputs):
    """Two writers offer all rows at the same time; each id is stored once."""
    path, offered = t.scratch(), rows(t)
    with ThreadPoolExecutor(2) as writers:
        done = list(writers.map(lambda k: insert_or_ignore(offered, path, "race_id", [F.asc("arrival")], partition="meeting_date"), range(2)))
    return read_keyed(t.spark, path, offered.schema).withColumn("n_inserted", F.lit(sum(done)))


add("s10_two_writers", f"{RACE_ROW} arrival:l n_inserted:l", inserted_at_once, "SELECT *, (SELECT COUNT(*) FROM m_history_rows) AS n_inserted FROM m_history_rows")

# ---------------------------------------------------------------- scalar rules
add("x2_prize", "arrival:l prize prize_total:f bad:b",
    lambda t: forms(t("form_raw")).select("arrival", F.try_variant_get("form", "$.prizeMoney", "string").alias("prize"))
    .select("arrival", "prize", parsing.prize_total(F.col("prize")).alias("prize_total"),
            parsing.unreadable(F.col("prize"), parsing.prize_total(F.col("prize"))).alias("bad"))
    .withColumn("bad", F.coalesce("bad", F.lit(False))),
    """SELECT *, COALESCE(prize, '') <> '' AND prize_total IS NULL AS bad FROM (
       SELECT arrival, prize, TRY_CAST(REPLACE(REPLACE(prize, '$', ''), ',', '') AS DOUBLE) AS prize_total FROM (
       SELECT arrival, CASE WHEN json_valid(body) THEN body ->> '$.prizeMoney' END AS prize FROM form_raw))""")
add("x3_distance", "arrival:l distance distance_meters:l",
    lambda t: forms(t("form_raw")).select("arrival", F.try_variant_get("form", "$.distance", "string").alias("distance"))
    .withColumn("distance_meters", parsing.distance_meters(F.col("distance"))),
    """SELECT *, TRY_CAST(REPLACE(distance, 'm', '') AS INTEGER) AS distance_meters FROM (
       SELECT arrival, CASE WHEN json_valid(body) THEN body ->> '$.distance' END AS distance FROM form_raw)""")
# Order keys as race numbers: one to many digits.
add("x4_race_id", "race_id meeting_id o_orderkey:l",
    lambda t: t("orders").select(
        "o_orderkey",
        keys.race_id(F.col("o_orderstatus"), F.col("o_orderdate"), F.col("o_orderkey")).alias("race_id"),
        keys.meeting_id(F.col("o_orderstatus"), F.col("o_orderdate")).alias("meeting_id")),
    """SELECT o_orderkey, m AS meeting_id, m || CASE WHEN o_orderkey < 10 THEN '0' ELSE '' END || o_orderkey AS race_id
       FROM (SELECT o_orderkey, o_orderstatus || strftime(o_orderdate, '%d%m%Y') AS m FROM orders)""")
add("x6_code_fallback", "c_custkey:l code",
    lambda t: t("customer").select("c_custkey", keys.track_code(F.col("c_name"), F.lit(None).cast("string")).alias("code")),
    "SELECT c_custkey, UPPER(SUBSTR(c_name, 1, 3)) AS code FROM customer")
add("x8_short_name", "arrival:l short_race_name valid_name:b",
    lambda t: race_history.parse_forms(t("form_raw")).join(
        forms(t("form_raw")).select("arrival", F.schema_of_variant(F.try_variant_get("form", "$.raceName", "variant")).alias("kind")),
        "arrival").select("arrival", "short_race_name", F.coalesce(F.col("kind") == "STRING", F.lit(True)).alias("valid_name")),
    """SELECT arrival, SUBSTR(COALESCE(n, ''), 1, 100) AS short_race_name, COALESCE(k = 'VARCHAR', TRUE) AS valid_name FROM (
       SELECT arrival, CASE WHEN json_valid(body) THEN body ->> '$.raceName' END AS n,
              CASE WHEN json_valid(body) THEN json_type(body, '$.raceName') END AS k FROM form_raw)""")
add("x12_date_text", "o_orderkey:l day instant",
    lambda t: t("orders").select("o_orderkey", dates.day_text(F.col("o_orderdate")).alias("day"), dates.instant_text(F.col("o_orderdate")).alias("instant")),
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS instant FROM orders")
add("x13_local_day_window", "o_orderkey:l from_utc to_utc",
    lambda t: t("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")).select(
        "o_orderkey", dates.instant_text(dates.window_start_utc(F.col("day"))).alias("from_utc"),
        dates.instant_text(dates.window_end_utc(F.col("day"))).alias("to_utc")),
    """SELECT o_orderkey,
       strftime(date_trunc('day', o_orderdate) AT TIME ZONE 'Australia/Sydney' AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS from_utc,
       strftime((date_trunc('day', o_orderdate) + INTERVAL 86399 SECOND) AT TIME ZONE 'Australia/Sydney' AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS to_utc
       FROM orders""")
add("x14_date_argument", "o_orderkey:l day:d",
    lambda t: t("orders").select("o_orderkey", dates.day_from_argument(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day")),
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
add("x17_slug_or_track", "meeting_date:d track",
    lambda t: meetings(t("meetings_raw")).select("meeting_date", keys.slug_or_track(F.col("slug"), F.col("track")).alias("track")),
    "SELECT meeting_date, COALESCE(NULLIF(slug, ''), track) AS track FROM m_meetings")
add("x18_lower", "track slug arrival:l", lambda t: t("form_raw").withColumn("slug", F.lower("track")),
    "SELECT track, LOWER(track) AS slug, arrival FROM form_raw")
model("m_spine", """SELECT CAST(UNNEST(generate_series(last_day - INTERVAL 365 DAY, last_day, INTERVAL 1 DAY)) AS DATE) AS day
    FROM (SELECT CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders)""")


def spine(t: Inputs):
    return dates.date_spine(t("orders").agg(F.max("o_orderdate").cast("date").alias("last_day")))


def orders_per_day(t: Inputs):
    per_day = t("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return spine(t).join(per_day, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


add("x19_date_spine", "day:d n:l", orders_per_day,
    """SELECT s.day, COUNT(o.o_orderkey) AS n FROM m_spine s LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = s.day GROUP BY 1""")

# ---------------------------------------------------------------- request plan
ASKED = 10  # fixed value: race numbers asked for per meeting
model("m_requests", """SELECT meeting_date, COALESCE(NULLIF(slug, ''), track) AS track, UNNEST(range(1, 11)) AS race_num FROM m_meetings""")
PLAN = "meeting_date:d track race_num:l"
add("request_plan", PLAN, lambda t: race_history.request_plan(t("meetings_raw"), ASKED), "SELECT * FROM m_requests")
add("j11_dates_meetings_races", PLAN,
    lambda t: race_history.request_plan(t("meetings_raw"), ASKED, spine(t)),
    "SELECT * FROM m_requests WHERE meeting_date IN (SELECT day FROM m_spine)")
add("s8_meeting_rejects", "meeting_date:d body", lambda t: meeting_rejects(t("meetings_raw")),
    """SELECT meeting_date, body FROM meetings_raw WHERE http_status = 200 AND (NOT json_valid(body)
       OR (CASE WHEN json_valid(body) THEN json_type(body, '$') END) <> 'OBJECT'
       OR COALESCE(CASE WHEN json_valid(body) THEN json_type(body, '$.meetings') END, 'NULL') NOT IN ('ARRAY', 'NULL'))""")
assert set(RACE.names) == {c.split(":")[0] for c in RACE_TABLE.split()}
