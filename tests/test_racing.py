"""Race history, request plan, Gold join, keyed sink."""

from __future__ import annotations

import json
import random
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from furlong.functions.tracks import tracks_table
from furlong.operators.joins import repeat_rows
from furlong.plans import race_history, race_run, racing
from furlong.schemas import FORM_RESPONSES, RACE, SILVER_RUNNERS
from furlong.sources import commits
from furlong.sources.keyed import add_versions, compact_latest, insert_or_ignore, new_rows, read_keyed, read_latest
from furlong.sources.landing import meetings
from tests.conftest import rows

DAY = date(2025, 1, 15)
GOOD = {"raceName": "Cup", "prizeMoney": "$1,250,000", "distance": "1400m", "raceClass": "G1", "date": "2025-01-15",
        "condition": "Good", "numberOfRunners": 8}


def forms(spark, *responses):
    """Responses as (track, race number, status, body); a dict is sent as JSON."""
    data = [(DAY, t, n, s, b if isinstance(b, (str, type(None))) else json.dumps(b), i) for i, (t, n, s, b) in enumerate(responses)]
    return spark.createDataFrame(data, FORM_RESPONSES)


def history(spark, *responses, **options):
    return race_history.race_history(forms(spark, *responses), tracks_table(spark), F.lit(datetime(2026, 1, 1)), **options)


def test_race_row(spark):
    r = history(spark, ("Flemington", 7, 200, GOOD)).first()
    assert history(spark, ("x", 1, 200, GOOD)).columns == RACE.names
    assert (r.race_id, r.meeting_id, r.venue, r.race_order) == ("FLM1501202507", "FLM15012025", "Flemington", 7)
    assert (r.prize_total, r.distance_meters, r.field_size, r.race_status) == (1250000.0, 1400, 8, "completed")
    assert r.scheduled_date == DAY and r.extracted_at == r.record_created_date == datetime(2026, 1, 1)


def test_stops_at_the_first_failure_of_a_meeting(spark):
    responses = [("a", n, 404 if n == 3 else 200, GOOD) for n in (5, 4, 1, 2, 3)] + [("b", 4, 200, GOOD), ("c", 1, 500, GOOD), ("c", 2, 200, GOOD)]
    got = race_history.answered_prefix(forms(spark, *responses))
    assert rows(got, "track", "race_num") == [("a", 1), ("a", 2), ("b", 4)]


def test_all_landed_races_count(spark):
    responses = [("a", 10, 200, GOOD), ("a", 11, 200, GOOD), ("a", 12, 200, GOOD), ("b", 11, 404, GOOD), ("b", 12, 200, GOOD)]
    assert sorted(r.race_order for r in history(spark, *responses).collect()) == [10, 11, 12]


def test_no_status_ends_the_meeting_and_rejects_are_told(spark):
    responses = [("a", 1, 200, GOOD), ("a", 2, None, GOOD), ("a", 3, 200, GOOD), (None, 1, 200, GOOD), ("c", 1, 200, "broken")]
    landed = forms(spark, *responses)
    assert [r.race_order for r in history(spark, *responses).collect()] == [1]
    assert race_history.race_rejects(landed).count() == 2
    counts = race_history.race_audit(landed, tracks_table(spark), F.lit(datetime(2026, 1, 1))).first()
    assert tuple(counts) == (3, 1, 0, 2)


def test_a_run_stores_races_rejects_and_counts(spark, tmp_path):
    paths = race_run.RacePaths(*(str(tmp_path / n) for n in ("races", "attempts", "audit")))
    first = forms(spark, ("a", 1, 200, GOOD), ("a", 2, 200, "broken"), ("a", 3, 200, GOOD), ("a", 3, 200, GOOD))
    second = forms(spark, ("a", 1, 200, GOOD), ("b", 1, 200, GOOD), ("c", 1, 404, GOOD), ("c", 2, 200, GOOD))
    now = F.lit(datetime(2026, 1, 1))
    assert race_run.run_history(first, tracks_table(spark), paths, "one", now).first()[1:] == (4, 2, 1, 1)
    for _ in range(2):  # a second time changes nothing
        assert race_run.run_history(second, tracks_table(spark), paths, "two", now).first()[1:] == (2, 1, 1, 0)
    assert rows(race_run.read_races(spark, paths.races), "venue", "race_order", "run_id") == [("a", 1, "one"), ("a", 3, "one"), ("b", 1, "two")]
    assert [r.race_order for r in race_run.read_rejects(spark, paths.attempts, "one").collect()] == [2]
    assert race_run.read_rejects(spark, paths.attempts, "two").count() == 0
    assert rows(race_run.read_counts(spark, paths.audit), "run_id", "attempted") == [("one", 4), ("two", 2)]


def test_a_run_that_stopped_before_its_counts_is_counted_whole(spark, tmp_path):
    paths, now = race_run.RacePaths(*(str(tmp_path / n) for n in ("races", "attempts", "audit"))), F.lit(datetime(2026, 1, 1))
    landed = forms(spark, ("a", 1, 200, GOOD), ("a", 2, 200, GOOD))
    # The races were added, the counts were not.
    race_run.run_history(landed, tracks_table(spark), race_run.RacePaths(paths.races, paths.attempts, str(tmp_path / "lost")), "one", now)
    assert race_run.run_history(landed, tracks_table(spark), paths, "one", now).first()[1:] == (2, 2, 0, 0)


@pytest.mark.parametrize("change,kept", [
    ({"prizeMoney": "N/A"}, False), ({"prizeMoney": ""}, True), ({"prizeMoney": None}, True), ({"prizeMoney": 0}, True),
    ({"prizeMoney": 500}, False), ({"distance": "1400 metres"}, False), ({"distance": ""}, True), ({"distance": 1400}, False),
    ({"raceName": None}, False), ({"raceName": 5}, False), ({"date": "soon"}, False), ({"date": None}, True),
    ({"numberOfRunners": "8"}, True), ({"numberOfRunners": "many"}, False), ({"raceClass": {"a": 1}}, False), ({"condition": None}, True),
])
def test_rows_that_do_not_parse_are_left_out(spark, change, kept):
    # The next race goes on: only a status ends a meeting.
    got = history(spark, ("a", 1, 200, {**GOOD, **change}), ("a", 2, 200, GOOD))
    assert [r.race_order for r in got.orderBy("race_order").collect()] == ([1, 2] if kept else [2])


def test_bodies_that_are_no_object(spark):
    assert history(spark, ("a", 1, 200, "oops"), ("a", 2, 200, "[]"), ("a", 3, 200, None), (None, 4, 200, GOOD)).count() == 0


def test_missing_name_is_empty_and_long_name_is_cut(spark):
    nameless = {k: v for k, v in GOOD.items() if k != "raceName"}
    got = {r.race_order: (r.race_name, r.short_race_name) for r in history(spark, ("a", 1, 200, nameless), ("a", 2, 200, {**GOOD, "raceName": "x" * 120})).collect()}
    assert got == {1: (None, ""), 2: ("x" * 120, "x" * 100)}


def test_first_arrival_of_an_id_wins(spark):
    # Unmapped "benx" falls back to BEN, the code of bendigo.
    got = history(spark, ("benx", 1, 200, GOOD), ("bendigo", 1, 200, GOOD), ("BENDIGO", 1, 200, GOOD))
    assert [(r.race_id, r.venue) for r in got.collect()] == [("BEN1501202501", "benx")]


def test_request_plan(spark):
    body = json.dumps({"meetings": [{"slug": "s", "track": "t"}, {"slug": "", "track": "u"}, {"track": "v"}]})
    df = spark.createDataFrame([(DAY, 200, body), (date(2025, 1, 16), 500, body), (date(2025, 1, 17), 200, "{}"), (date(2025, 1, 18), 200, "x")],
                               "meeting_date date, http_status int, body string")
    assert meetings(df).count() == 3
    plan = race_history.request_plan(df, 10)
    assert plan.count() == 30 and {r.track for r in plan.collect()} == {"s", "u", "v"}
    assert race_history.request_plan(df, 10, spark.createDataFrame([(date(2025, 1, 16),)], "day date")).count() == 0


# ---------------------------------------------------------------- Gold
def silver(spark, records):
    names = SILVER_RUNNERS.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], SILVER_RUNNERS)


def test_gold_join_equals_a_plain_join(spark):
    rng = random.Random(3)
    # One race holds a third of the rows; race columns differ within races; some keys are NULL.
    records = []
    for i in range(150):
        hot = i % 3 == 0
        records.append({
            "track": "hot" if hot else rng.choice(["a", "b", None]), "race_number": 1 if hot else rng.randint(1, 2), "race_date": DAY,
            "race_name": rng.choice(["x", "y", None]), "distance_m": 1000, "horse_name": f"h{i}", "barrier": i,
            "scratched": rng.choice([True, False, False, None])})
    df = silver(spark, records)
    races, runners = racing.races(df), racing.runners(df)
    races.createOrReplaceTempView("r")
    runners.createOrReplaceTempView("u")
    want = spark.sql("""SELECT r.track, r.race_number, r.race_date, r.race_name, r.distance_m, r.track_condition, u.horse_name, u.jockey,
        u.trainer, u.barrier, u.weight_kg, u.overall_win_pct FROM r JOIN u USING (track, race_number, race_date)""")
    got = racing.race_runners(races, runners)
    assert got.columns == want.columns and rows(got) == rows(want)
    n = Counter((r["track"], r["race_number"]) for r in records if r["track"])
    m = Counter((r["track"], r["race_number"]) for r in records if r["track"] and r["scratched"] is False)
    assert got.count() == sum(n[k] * m[k] for k in n)


@pytest.mark.parametrize("copies", [1, 2, 63, 64, 65, 128, 5000])
def test_repeat_rows(spark, copies):
    df = spark.createDataFrame([("a", copies), ("b", 1), ("a", 70), ("a", 70), (None, 65)], "k string, n long")
    got = repeat_rows(df, "n")
    assert got.columns == ["k"] and rows(got.groupBy("k").count()) == sorted([("a", copies + 140), ("b", 1), (None, 65)], key=str)


def test_a_hot_race_leaves_from_several_tasks(spark):
    # 3,000 race rows and 3,000 runners of one race: 9,000,000 rows from 3,000 matches.
    n = F.col("id")
    df = spark.range(3000).select(
        F.lit("hot").alias("track"), F.lit(1).alias("race_number"), F.lit(DAY).alias("race_date"), F.lit("x").alias("race_name"), F.lit(1000).alias("distance_m"),
        F.lit(None).cast("string").alias("race_class"), F.lit("Good").alias("track_condition"), F.concat(F.lit("h"), n).alias("horse_name"), F.lit("j").alias("jockey"),
        F.lit("t").alias("trainer"), n.cast("int").alias("barrier"), F.lit(50.0).alias("weight_kg"), F.lit(1).alias("overall_starts"), F.lit(1).alias("overall_wins"),
        F.lit(0.5).alias("overall_win_pct"), F.lit(False).alias("scratched"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for horses in (df, df.withColumn("horse_name", F.lit("same")).withColumn("barrier", F.lit(1))):
            per_task = [r["count"] for r in racing.race_runners(racing.races(horses), racing.runners(horses)).groupBy(F.spark_partition_id()).count().collect()]
            assert sum(per_task) == 9_000_000 and len(per_task) == 4 and max(per_task) < 3_000_000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


# ---------------------------------------------------------------- keyed sink
def batch(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int, day string, at long")


def test_insert_or_ignore(spark, tmp_path):
    path = str(tmp_path / "t")
    first = batch(spark, ("a", 1, "d1", 2), ("a", 2, "d1", 1), ("b", 3, "d2", 3))
    second = batch(spark, ("a", 9, "d1", 4), ("c", 5, "d2", 5))
    for df in (first, first, second, second):
        insert_or_ignore(df, path, "k", [F.asc("at")], drop=("at",), partition="day")
    assert rows(read_keyed(spark, path, first.drop("at").schema)) == [("a", 2, "d1"), ("b", 3, "d2"), ("c", 5, "d2")]


def test_only_touched_partitions_of_the_target_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("concat('k', id) k", "cast(id as int) v", "concat('d', id % 50) day").write.partitionBy("day").parquet(path)
    target = spark.read.schema("k string, v int, day string").parquet(path)
    fresh = new_rows(batch(spark, ("k1", 1, "d1", 1), ("new", 2, "d1", 2)), target, "k", [F.asc("at")], "day")
    assert [r.k for r in fresh.collect()] == ["new"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan and "= d1)" in plan and "LeftAnti" in plan


def test_two_interleaved_writers_store_each_id_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    mine = batch(spark, ("a", 1, "d1", 1), ("b", 1, "d1", 1), ("c", 1, "d2", 1))
    theirs = batch(spark, ("b", 2, "d1", 1), ("d", 2, "d2", 1))
    write = lambda df: insert_or_ignore(df, path, "k", [F.asc("at")], partition="day")
    publish, between, counts = commits.publish, [theirs, batch(spark, ("e", 3, "d3", 1)), mine], []

    def late(*given):  # others write between this one's reading and its publishing
        if between:
            df = between.pop(0)
            counts.append(write(df))
        return publish(*given)

    monkeypatch.setattr(commits, "publish", late)
    counts.append(write(mine))
    stored = rows(read_keyed(spark, path, mine.schema), "k", "v")
    assert [k for k, _ in stored] == ["a", "b", "c", "d", "e"] and sum(counts) == 5
    assert dict(stored)["e"] == 3 and write(mine) == write(theirs) == 0
    version = commits.newest(spark, path)
    assert sorted(p.name for p in (tmp_path / "t" / "data").iterdir()) == sorted(version.folders)


def test_threads_that_write_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    offers = [batch(spark, *((f"k{i}", w, "d", i) for i in range(w, 40 + w))) for w in range(4)]
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda df: insert_or_ignore(df, path, "k", [F.asc("at")]), offers))
    stored = rows(read_keyed(spark, path, offers[0].schema), "k")
    assert len(stored) == len(set(stored)) == 43 == sum(done)


def test_a_version_is_published_once(spark, tmp_path):
    path = str(tmp_path)
    assert commits.newest(spark, path) == commits.Version(0, ())
    assert commits.publish(spark, path, commits.Version(1, ("a",))) and not commits.publish(spark, path, commits.Version(1, ("b",)))
    assert commits.newest(spark, path) == commits.Version(1, ("a",))
    assert not [p for p in (tmp_path / "_commits").iterdir() if not p.name.endswith((".json", ".crc"))]


def test_compaction_keeps_what_came_in_between(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path), "k string, at long, v int"
    schema = spark.createDataFrame([], schema).schema
    add = lambda name, *data: add_versions(spark.createDataFrame(data, schema), path, f"part={name}")
    add("1", ("a", 2, 20), ("b", 1, 1))
    add("2", ("a", 1, 10), ("b", 5, 50))
    add("2", ("a", 9, 90))  # that folder is in the table already
    publish, other = commits.publish, [("a", 7, 70)]

    def late(*given):
        if other:
            add("3", other.pop())
        return publish(*given)

    monkeypatch.setattr(commits, "publish", late)
    compact_latest(spark, path, schema, "k", ("at",))
    assert len(commits.newest(spark, path).folders) == 2
    assert rows(read_latest(spark, path, schema, "k", ("at",))) == [("a", 7, 70), ("b", 5, 50)]
