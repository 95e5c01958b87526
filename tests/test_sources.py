"""Bronze files, the daily run, tables, streaming."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from glob import glob

import pytest
from pyspark.sql import functions as F

from furlong.plans import bronze_run
from furlong.plans.bronze_run import BronzePaths, RunResult
from furlong.schemas import BOOK, CATALOGUE, CATALOGUE_PATHS
from furlong.sources import bronze, commits, landing, tables
from furlong.sources.keyed import read_keyed, read_latest
from furlong.streaming import drift, files, progress
from tests.conftest import rows
from tests.test_gate import market

DAY = "2026-05-01"
MORNING = datetime(2026, 4, 30, 21, 30, tzinfo=timezone.utc)  # 07:30 in Sydney
EVENING = datetime(2026, 5, 1, 13, 30, tzinfo=timezone.utc)  # 23:30 in Sydney


def catalogue_rows(spark, n):
    base = spark.range(n).select(F.concat(F.lit("1."), "id").alias("market_id"))
    rest = [f for f in CATALOGUE.fields if f.name != "market_id"]
    return base.select("market_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest])


def test_files_are_capped_and_nulls_written(spark, tmp_path):
    root = str(tmp_path / "c")
    bronze.write_ndjson(bronze.stamp(catalogue_rows(spark, 120).coalesce(1), DAY, "07-30"), root, bronze.CATALOGUE_RECORDS_PER_FILE)
    lines = [open(f).read().splitlines() for f in glob(f"{root}/extracted_date={DAY}/run_time=07-30/*.json")]
    assert sorted(map(len, lines)) == [20, 50, 50]
    assert set(json.loads(lines[0][0])) == set(CATALOGUE.names)


def test_backfill_of_many_days_writes_few_files(spark, tmp_path):
    rows_of_days = catalogue_rows(spark, 400).repartition(8).withColumns({
        "extracted_date": F.expr("date_add(DATE'2026-05-01', CAST(substr(market_id, 3) AS INT) % 10)"), "run_time": F.lit("07-30")})
    for many_days in (False, True):
        root = str(tmp_path / f"c{many_days}")
        bronze.write_ndjson(rows_of_days, root, many_days=many_days)
        files_written = len(glob(f"{root}/*/*/*.json"))
        assert (files_written <= 20) is many_days
        assert bronze.read_ndjson(spark, root, CATALOGUE).select("market_id").distinct().count() == 400


def test_day_scan_reads_one_day_and_all_its_runs(spark, tmp_path):
    root = str(tmp_path / "c")
    for day, run in ((DAY, "07-30"), (DAY, "11-00"), ("2026-05-02", "07-30")):
        bronze.write_ndjson(bronze.stamp(catalogue_rows(spark, 2), day, run), root)
    df = bronze.read_ndjson(spark, root, CATALOGUE, DAY)
    assert df.count() == 4 and {r.run_time for r in df.collect()} == {"07-30", "11-00"}
    assert all(f"extracted_date={DAY}" in f for f in df.inputFiles())
    assert bronze.read_ndjson(spark, root, CATALOGUE).count() == 6
    assert bronze.read_ndjson(spark, root, CATALOGUE, "2020-01-01").count() == 0


def test_an_empty_file_counts_as_there_and_reads_as_no_rows(spark, tmp_path):
    folder = tmp_path / "b" / f"extracted_date={DAY}" / "run_time=11-00"
    assert not bronze.has_files(spark, str(tmp_path / "b"), DAY)
    folder.mkdir(parents=True)
    (folder / "batch_0.json").write_text("")
    assert bronze.has_files(spark, str(tmp_path / "b"), DAY)
    assert bronze.read_ndjson(spark, str(tmp_path / "b"), BOOK, DAY).count() == 0


def responses(spark, *objects, day=DAY):
    return spark.createDataFrame([(json.dumps(list(objects)), day)], "body string, extracted_date string").withColumn(
        "extracted_date", F.col("extracted_date").cast("date"))


def book(i, **changes):
    return {"marketId": i, "status": "OPEN", "runners": [], "version": 1, **changes}


@pytest.fixture
def paths(tmp_path):
    return BronzePaths(*[str(tmp_path / n) for n in ("catalogue", "book", "quarantine")])


def test_run_all(spark, paths):
    late = market(marketId="1.9", marketStartTime="2026-05-02T02:00:00.000Z")
    c = responses(spark, market(), market(marketId=7), late)
    b = responses(spark, book("1.1"), book("1.1", version="x"), book("9.9"))
    assert bronze_run.run("all", c, b, paths, DAY, MORNING) == {"catalogue": RunResult(False, 1, 1), "book": RunResult(False, 1, 1)}
    assert bronze.read_ndjson(spark, paths.catalogue, CATALOGUE, DAY).first().run_time == "07-30"
    assert spark.read.json(f"{paths.quarantine}/catalogue").first().gate_errors == ["market_id"]
    # Again: both are there. Forced: a second run folder beside the first.
    assert bronze_run.run("all", c, b, paths, DAY, EVENING) == {"catalogue": RunResult(True), "book": RunResult(True)}
    assert bronze_run.run("all", c, b, paths, DAY, EVENING, overwrite=True)["book"].success == 1
    stored = bronze.read_ndjson(spark, paths.book, BOOK, DAY)
    assert {r.run_time for r in stored.collect()} == {"07-30", "23-30"}


def test_a_run_keeps_to_its_day(spark, paths):
    other = "2026-05-02"
    c = responses(spark, market(), market(marketId="1.3", marketStartTime=5), "no market").union(responses(spark, market(), market(marketId=8), day=other))
    b = responses(spark, book("1.1")).union(responses(spark, book("1.1", status="CLOSED"), book("1.1", version="x"), day=other))
    # A start time of a wrong type and an unreadable record are rejects of their day.
    assert bronze_run.run("all", c, b, paths, DAY, MORNING) == {"catalogue": RunResult(False, 1, 2), "book": RunResult(False, 1, 0)}
    assert [r.status for r in bronze.read_ndjson(spark, paths.book, BOOK).collect()] == ["OPEN"]


def test_a_forced_run_of_the_same_minute_replaces(spark, paths):
    c, b = responses(spark, market(), market(marketId=7)), responses(spark, book("1.1"), book("1.1", version="x"))
    first = bronze_run.run("all", c, b, paths, DAY, MORNING)
    assert bronze_run.run("all", c, b, paths, DAY, MORNING, overwrite=True) == first
    assert bronze.read_ndjson(spark, paths.catalogue, CATALOGUE).count() == 1 and bronze.read_ndjson(spark, paths.book, BOOK).count() == 1
    assert spark.read.json(f"{paths.quarantine}/book").count() == 1
    # Without rows this time: nothing of the run before is left.
    assert bronze_run.run("catalogue", responses(spark, []), None, paths, DAY, MORNING, overwrite=True) == {"catalogue": RunResult(False, 0, 1)}
    assert bronze_run.run("catalogue", responses(spark), None, paths, DAY, MORNING, overwrite=True) == {"catalogue": RunResult(False, 0, 0)}
    assert bronze.read_ndjson(spark, paths.catalogue, CATALOGUE).count() == 0
    assert spark.read.schema("record string").json(f"{paths.quarantine}/catalogue").count() == 0
    assert [tuple(r)[:1] + tuple(r)[3:] for r in bronze_run.results_table(spark, first, DAY, MORNING).collect()] == [
        ("catalogue", False, 1, 1), ("book", False, 1, 1)]


def test_outcomes_of_runs_are_kept(spark, paths, tmp_path):
    audit = str(tmp_path / "results")
    bronze_run.run("catalogue", responses(spark), None, paths, DAY, MORNING, audit=audit)
    bronze_run.run("book", None, responses(spark, book("1.1")), paths, DAY, MORNING, audit=audit)
    got = bronze_run.read_results(spark, audit).orderBy("feed").collect()
    assert [(r.feed, str(r.extracted_date), r.skipped, r.success, r.failed) for r in got] == [("book", DAY, False, 0, 0), ("catalogue", DAY, False, 0, 0)]


def test_no_markets_no_book(spark, paths):
    got = bronze_run.run("all", responses(spark), responses(spark, book("1.1")), paths, DAY, MORNING)
    assert got == {"catalogue": RunResult(False, 0, 0)}
    assert bronze_run.run("book", None, responses(spark, book("1.1")), paths, DAY, MORNING) == {"book": RunResult(False, 0, 0)}


def test_default_day_is_today_in_sydney(spark, paths):
    bronze_run.run("catalogue", responses(spark, market()), None, paths, now=MORNING)
    assert bronze.has_files(spark, paths.catalogue, DAY)
    with pytest.raises(ValueError):
        bronze_run.run("other", None, None, paths)


def test_landed_bodies(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.json").write_text(json.dumps([market()]) + "\n" + json.dumps([]) + "\n")
    assert landing.records(landing.read_bodies(spark, str(tmp_path / "l"))).count() == 1
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.json").write_text(json.dumps({"http_status": 200, "body": "{}", "meeting_date": "2026-05-01"}))
    from furlong.schemas import MEETING_RESPONSES
    assert landing.read_responses(spark, str(tmp_path / "r"), MEETING_RESPONSES).first().http_status == 200


def test_tables(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,name,tax_rate,opened_at\n1,Vice City,0.2,2016-09-01T00:00:00\n")
    seeded = tables.load_seed(spark, str(tmp_path / "s.csv"), "raw_stores", "fur_t", str(tmp_path / "t"))
    assert seeded.count() == 1 and tables.source(spark, "fur_t", "raw_stores").first().tax_rate == 0.2
    assert rows(tables.list_tables(spark, "fur_t_raw")) == [("raw_stores",)]
    columns = tables.list_columns(spark, "fur_t_raw.raw_stores")
    assert [r.column_name for r in columns.orderBy("ordinal_position").collect()] == ["id", "name", "tax_rate", "opened_at"]
    assert tables.freshness(seeded, "raw_stores").first().max_loaded_at == datetime(2016, 9, 1)
    assert tables.catalog_table(spark, "spark_catalog", "fur_t_raw", "raw_stores").count() == 1
    with pytest.raises(KeyError):
        tables.source(spark, "fur_t", "raw_other")


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pair = [tables.as_table(spark.range(100).withColumnRenamed("id", "k"), f"fur_b{i}", str(tmp_path / f"b{i}"), bucket_by=(4, "k")) for i in (1, 2)]
        plan = pair[0].join(pair[1], "k")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---------------------------------------------------------------- streaming
def land(folder, name, *objects):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(o) for o in objects))


def test_ingest_picks_up_only_new_files(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for n in (1, 2):
        land(source, f"{n}.json", {"k": n}, {"k": n})
        files.ingest(files.read_new(spark, str(source), spark.range(0).withColumnRenamed("id", "k").schema), out, state).awaitTermination()
        assert spark.read.parquet(out).count() == 2 * n


def test_distinct_keys_across_batches(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for n in (1, 2):
        land(source, f"{n}.json", {"k": "a", "day": "2026-05-01T00:00:00"}, {"k": f"b{n}", "day": "2026-05-01T00:00:00"})
        stream = files.read_new(spark, str(source), spark.sql("SELECT '' AS k, current_timestamp() AS day").schema)
        files.ingest(files.distinct_keys(stream, ["day", "k"], "day", "7 days"), out, state).awaitTermination()
    assert rows(spark.read.parquet(out), "k") == [("a",), ("b1",), ("b2",)]


def test_first_writer_over_batches(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "table")
    for n, objects in enumerate(([("a", 5), ("a", 4), ("b", 9)], [("a", 1), ("c", 7)], [("c", 2), ("b", 3), ("d", 8)])):
        land(source, f"{n}.json", *[{"k": k, "at": at} for k, at in objects])
        stream = files.read_new(spark, str(source), spark.sql("SELECT '' AS k, 0 AS at").schema)
        files.insert_new(stream, table, "k", ["at"], str(tmp_path / "state")).awaitTermination()
    # The earliest batch has the key; in a batch the lowest `at` does.
    assert rows(read_keyed(spark, table, stream.schema), "k", "at") == [("a", 4), ("b", 9), ("c", 7), ("d", 8)]


def test_stream_gate_and_insert(spark, tmp_path):
    source, state = tmp_path / "in", str(tmp_path / "state")
    out, bad, table = str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "table")
    for n, objects in enumerate(([market(), market(marketId=3)], [market(), market(marketId="1.2")])):
        land(source, f"{n}.json", {"body": json.dumps(objects)})
        stream = files.read_new(spark, str(source), spark.sql("SELECT '' AS body").schema)
        files.gate_to(stream, CATALOGUE, CATALOGUE_PATHS, out, bad, state).awaitTermination()
    assert rows(spark.read.json(out), "market_id") == [("1.1",), ("1.1",), ("1.2",)]
    assert spark.read.json(bad).count() == 1
    accepted = files.read_new(spark, out, spark.sql("SELECT '' AS market_id, 0 AS batch_id").schema)
    for attempt in range(2):
        files.insert_new(accepted, table, "market_id", ["batch_id"], str(tmp_path / f"state{attempt}")).awaitTermination()
    assert rows(read_keyed(spark, table, accepted.schema), "market_id", "batch_id") == [("1.1", 0), ("1.2", 1)]


def stream_of(spark, source, schema):
    return files.read_new(spark, str(source), spark.createDataFrame([], schema).schema)


def test_latest_rows_whatever_the_order_of_batches(spark, tmp_path):
    source, table, schema = tmp_path / "in", str(tmp_path / "table"), "k string, at long, v string"
    kind, state = spark.createDataFrame([], schema).schema, tmp_path / "state"
    batches = ([("a", 5, "x"), ("b", 1, "y")], [("a", 2, "old"), ("b", 3, "new")], [("c", 1, "z"), ("a", 5, "w")], [("a", 4, "late")])
    for n, objects in enumerate(batches):
        land(source, f"{n}.json", *[{"k": k, "at": at, "v": v} for k, at, v in objects])
        files.keep_latest(stream_of(spark, source, schema), "k", ("at",), ("v",), table, str(state)).awaitTermination()
    want = [("a", 5, "x"), ("b", 3, "new"), ("c", 1, "z")]
    assert rows(read_latest(spark, table, kind, "k", ("at",))) == want
    # The last batch changed nothing, so it committed a folder without rows or none; a new checkpoint starts at batch 0 again.
    before = commits.newest(spark, table)
    files.keep_latest(stream_of(spark, source, schema), "k", ("at",), ("v",), table, str(tmp_path / "again")).awaitTermination()
    assert commits.newest(spark, table).number == before.number + 1
    assert rows(read_latest(spark, table, kind, "k", ("at",))) == want


def test_distinct_within_a_delay_counts_every_row(spark, tmp_path):
    source, base, schema = tmp_path / "in", str(tmp_path), "k string, at timestamp"
    at = lambda day: f"2026-05-{day:02}T00:00:00"
    with progress.watched(spark) as seen:
        for n, objects in enumerate(([("a", 10), ("a", 11), ("b", 20)], [("a", 12), ("c", 14), ("c", 30)], [("d", 19), ("c", 29), ("e", 31), ("e", 31)])):
            land(source, f"{n}.json", *[{"k": k, "at": at(day)} for k, day in objects])
            kept = files.distinct_within(stream_of(spark, source, schema), ["k"], "at", "10 days")
            progress.finish(spark, files.ingest(kept, f"{base}/table", f"{base}/state"), seen, f"{base}/audit")
    # Watermarks: none, the 10th, the 20th.
    audit = progress.read_audit(spark, f"{base}/audit")
    assert rows(audit, "batch_id", "offered", "late", "duplicates") == [(0, 3, 0, 1), (2, 3, 0, 2), (4, 4, 1, 2)]
    assert rows(spark.read.parquet(f"{base}/table"), "k") == [("a",), ("b",), ("c",), ("e",)]


def test_streams_joined_in_time(spark, tmp_path):
    base = str(tmp_path)
    left, right = "k string, a timestamp", "k string, b timestamp"
    at = lambda day, hour=0: f"2026-05-{day:02}T{hour:02}:00:00"
    batches = (([("x", at(1)), ("y", at(9))], [("x", at(1, 5)), ("z", at(9))]), ([("z", at(8, 20)), ("old", at(2))], [("y", at(9, 23)), ("y", at(11)), ("x", at(20))]), ([("old", at(2)), ("w", at(20))], [("old", at(2, 1)), ("w", at(20, 1))]))
    with progress.watched(spark) as seen:
        for n, (a, b) in enumerate(batches):
            land(tmp_path / "l", f"{n}.json", *[{"k": k, "a": t} for k, t in a])
            land(tmp_path / "r", f"{n}.json", *[{"k": k, "b": t} for k, t in b])
            joined = files.joined_in_time(stream_of(spark, tmp_path / "l", left), stream_of(spark, tmp_path / "r", right), "k", "a", "b", "3 days", "1 DAY")
            progress.finish(spark, files.ingest(joined, f"{base}/table", f"{base}/state"), seen, f"{base}/audit")
    # After the first batch the watermark is the 6th: rows of the 2nd are late on either side.
    assert rows(spark.read.parquet(f"{base}/table"), "k") == [("w",), ("x",), ("y",), ("z",)]
    assert progress.read_audit(spark, f"{base}/audit").agg({"late": "sum"}).first()[0] == 3


def test_audit_of_the_streaming_gate(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path)
    for n, objects in enumerate(([market(), market(marketId=3)], [market(marketId=4)], [market()])):
        land(source, f"{n}.json", {"body": json.dumps(objects)})
        files.gate_to(stream_of(spark, source, "body string"), CATALOGUE, CATALOGUE_PATHS, f"{base}/ok", f"{base}/bad", f"{base}/state", audit=f"{base}/audit").awaitTermination()
    assert rows(spark.read.json(f"{base}/audit"), "batch_id", "success", "failed") == [(0, 1, 1), (1, 0, 1), (2, 1, 0)]


def test_keys_that_the_schema_lacks_are_rescued(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path)
    schema = spark.createDataFrame([], "k string, n long, tags array<string>").schema
    source.mkdir()
    batches = (['{"k": "a", "n": 1, "tags": ["x"]}', '{"k": null}'], ['{"k": "b", "n": "many", "new": {"deep": 1}}', '{"k": "c", "n": "7"}', '{"k": "d", "tags": "no list", "new": 2}'], ["oops", "[1]", ""])
    for n, lines in enumerate(batches):
        (source / f"{n}.json").write_text("\n".join(lines))
        for _ in range(2):  # nothing new the second time
            drift.ingest_rescued(drift.read_lines(spark, str(source)), schema, f"{base}/table", f"{base}/log", f"{base}/state").awaitTermination()
    stored = spark.read.schema("k string, n long, tags array<string>, rescued variant").parquet(f"{base}/table").withColumn("rescued", F.to_json("rescued"))
    assert rows(stored, "k", "n", "rescued") == sorted([
        ("a", 1, None), (None, None, None), ("b", None, '{"n":"many","new":{"deep":1}}'), ("c", 7, None), ("d", None, '{"new":2,"tags":"no list"}'),
        (None, None, '{"_line":"oops"}'), (None, None, '{"_line":"[1]"}')] + [(None, None, '{"_line":""}')] * (stored.count() - 7), key=str)
    log = [r for r in rows(drift.read_log(spark, f"{base}/log")) if r[1] != "_line"]
    assert log == [(1, "n", "STRING", 1), (1, "new", "BIGINT", 1), (1, "new", "OBJECT<deep: BIGINT>", 1), (1, "tags", "STRING", 1)]
