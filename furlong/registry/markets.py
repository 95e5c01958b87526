"""Catalogue, book, Bronze sinks and streaming queries."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.functions import dates
from furlong.functions.gate import accepted, rejected
from furlong.functions.predicates import has_text
from furlong.operators import keyed
from furlong.operators.ranking import batch_number, number_by_position
from furlong.plans import bronze_run, markets
from furlong.registry.core import Inputs, registry
from furlong.registry.racing import RACE_ROW, rows as race_rows
from furlong.schemas import BOOK, BOOK_PATHS, CATALOGUE, CATALOGUE_PATHS, with_partitions
from furlong.sources import audit, bronze, landing, tables
from furlong.sources.keyed import compact_latest, read_keyed, read_latest
from furlong.streaming import drift, files, progress

model, add = registry.model, registry.add

KEEP = ("extracted_date", "run_time", "arrival")
RUN = ("extracted_date", "run_time")

# ---------------------------------------------------------------- comparison SQL
model("m_cat_items", """SELECT extracted_date, run_time, arrival, j FROM (
    SELECT extracted_date, run_time, arrival, UNNEST(CAST(body AS JSON[])) AS j FROM catalogue_raw WHERE json_valid(body))""")
model("m_cat_wanted", """SELECT * FROM m_cat_items WHERE j ->> '$.eventType.id' = '7' AND j ->> '$.event.countryCode' = 'AU'
    AND j ->> '$.description.marketType' = 'WIN'""")


def _text_ok(path: str) -> str:
    return f"COALESCE(json_type(j, '{path}'), 'NULL') IN ('NULL', 'VARCHAR')"


def _float_ok(path: str) -> str:
    return (f"(COALESCE(json_type(j, '{path}'), 'NULL') IN ('NULL', 'BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN') OR "
            f"(json_type(j, '{path}') = 'VARCHAR' AND TRY_CAST(j ->> '{path}' AS DOUBLE) IS NOT NULL))")


def _float(path: str) -> str:
    return (f"CASE WHEN json_type(j, '{path}') = 'BOOLEAN' THEN CASE WHEN j ->> '{path}' = 'true' THEN 1.0 ELSE 0.0 END "
            f"ELSE TRY_CAST(j ->> '{path}' AS DOUBLE) END")


def _int_ok(path: str) -> str:
    return (f"(COALESCE(json_type(j, '{path}'), 'NULL') IN ('NULL', 'BIGINT', 'UBIGINT', 'BOOLEAN') OR "
            f"(json_type(j, '{path}') IN ('DOUBLE', 'VARCHAR') AND TRY_CAST(j ->> '{path}' AS DOUBLE) = FLOOR(TRY_CAST(j ->> '{path}' AS DOUBLE))))")


_TRUE, _FALSE = "('1', '1.0', 'on', 't', 'true', 'y', 'yes')", "('0', '0.0', 'off', 'f', 'false', 'n', 'no')"


def _bool(path: str) -> str:
    return f"CASE WHEN LOWER(j ->> '{path}') IN {_TRUE} THEN TRUE WHEN LOWER(j ->> '{path}') IN {_FALSE} THEN FALSE END"


def _bool_ok(path: str) -> str:
    return f"(COALESCE(json_type(j, '{path}'), 'NULL') = 'NULL' OR ({_bool(path)}) IS NOT NULL)"


_LIST_OK = """(COALESCE(json_type(j, '$.runners'), 'NULL') = 'NULL' OR (json_type(j, '$.runners') = 'ARRAY' AND
    len(list_filter(CAST(json_extract(j, '$.runners') AS JSON[]), lambda e: COALESCE(json_type(e), 'NULL') <> 'OBJECT')) = 0))"""
_RUNNERS = "CASE WHEN json_type(j, '$.runners') = 'ARRAY' THEN CAST(json_extract(j, '$.runners') AS JSON[]) END"


def _gate_sql(schema: T.StructType, paths: dict[str, str]) -> tuple[str, str]:
    """SELECT list and accept condition of a schema, in DuckDB."""
    ok = {T.StringType: _text_ok, T.DoubleType: _float_ok, T.IntegerType: _int_ok, T.LongType: _int_ok, T.BooleanType: _bool_ok}
    columns, conditions = [], []
    for f in schema.fields:
        path, kind = paths[f.name], type(f.dataType)
        if kind is T.ArrayType:
            columns.append(f"{_RUNNERS} AS runners")
            conditions.append(_LIST_OK)
            continue
        conditions.append(ok[kind](path))
        value = {T.StringType: f"j ->> '{path}'", T.DoubleType: _float(path), T.BooleanType: _bool(path)}.get(
            kind, f"CAST({_float(path)} AS BIGINT)")
        columns.append(f"{value} AS {f.name}")
    return ", ".join(columns), " AND ".join(conditions)


_cat_columns, _cat_ok = _gate_sql(CATALOGUE, CATALOGUE_PATHS)
_book_columns, _book_ok = _gate_sql(BOOK, BOOK_PATHS)
model("m_catalogue", f"SELECT extracted_date, run_time, arrival, {_cat_columns} FROM m_cat_wanted WHERE {_cat_ok}")
model("m_cat_unreadable", "SELECT extracted_date, run_time, arrival FROM catalogue_raw WHERE NOT json_valid(body)")
model("m_cat_rejected", f"""SELECT extracted_date, run_time, arrival FROM m_cat_wanted WHERE NOT ({_cat_ok})
    UNION ALL SELECT * FROM m_cat_unreadable""")
model("m_book_items", """SELECT extracted_date, run_time, arrival, UNNEST(CAST(body AS JSON[])) AS j FROM book_raw""")
model("m_book_all", f"SELECT extracted_date, run_time, arrival, {_book_columns} FROM m_book_items WHERE {_book_ok}")
model("m_book", "SELECT * FROM m_book_all WHERE marketId IN (SELECT market_id FROM m_catalogue WHERE market_id <> '')")

_letters = {T.StringType: "s", T.DoubleType: "f", T.IntegerType: "l", T.LongType: "l", T.BooleanType: "b"}


def _spec(schema: T.StructType) -> str:
    return " ".join(f"{f.name}:{_letters[type(f.dataType)]}" for f in schema.fields if type(f.dataType) in _letters)


RUN_SPEC = "extracted_date:d run_time"
CAT_SPEC = f"{RUN_SPEC} {_spec(CATALOGUE)} n_runners:l"
BOOK_SPEC = f"{RUN_SPEC} {_spec(BOOK)} n_runners:l"
_N = "len(runners) AS n_runners"


def counted(df):
    """The list of runners as its length, which both engines print alike."""
    return df.withColumn("n_runners", F.size("runners"))


def catalogue(t: Inputs):
    return markets.catalogue(t("catalogue_raw"), KEEP)


def all_books(t: Inputs):
    return accepted(markets.gated_book(t("book_raw"), KEEP))


def book(t: Inputs):
    return markets.books_of(all_books(t), catalogue(t))



# ---------------------------------------------------------------- sources
add("s6_catalogue_records", f"{RUN_SPEC} arrival:l market_id is_json:b",
    lambda t: landing.records(t("catalogue_raw"), KEEP).select(
        *KEEP, F.try_variant_get("record", "$.marketId", "string").alias("market_id"), F.col("record").isNotNull().alias("is_json")),
    """SELECT extracted_date, run_time, arrival, j ->> '$.marketId' AS market_id, TRUE AS is_json FROM m_cat_items
       UNION ALL SELECT *, NULL, FALSE FROM m_cat_unreadable""")
add("s7_book_records", f"{RUN_SPEC} arrival:l market_id",
    lambda t: landing.records(t("book_raw"), KEEP).select(*KEEP, F.try_variant_get("record", "$.marketId", "string").alias("market_id")),
    "SELECT extracted_date, run_time, arrival, j ->> '$.marketId' AS market_id FROM m_book_items")


def written_catalogue(t: Inputs, records_per_file: int | None = None) -> str:
    """Root folder of the catalogue, written as Bronze."""
    root = f"{t.scratch()}/catalogue"
    bronze.write_ndjson(catalogue(t).drop("arrival"), root, records_per_file, many_days=True)
    return root


def written_book(t: Inputs) -> str:
    """Root folder of the books of the markets in the stored catalogue, written as Bronze."""
    stored = bronze.read_ndjson(t.spark, written_catalogue(t), CATALOGUE)
    root = f"{t.scratch()}/book"
    bronze.write_ndjson(markets.books_of(all_books(t), stored).drop("arrival"), root, many_days=True)
    return root


# Whole jobs: gated, written, and read back from the folder.
add("catalogue_bronze", CAT_SPEC, lambda t: counted(bronze.read_ndjson(t.spark, written_catalogue(t), CATALOGUE)), f"SELECT *, {_N} FROM m_catalogue")
add("book_bronze", BOOK_SPEC, lambda t: counted(bronze.read_ndjson(t.spark, written_book(t), BOOK)), f"SELECT *, {_N} FROM m_book")

add("s1_scan_of_a_day", CAT_SPEC,
    lambda t: counted(bronze.read_ndjson(t.spark, written_catalogue(t), CATALOGUE, "2024-01-15")),
    f"SELECT *, {_N} FROM m_catalogue WHERE extracted_date = DATE '2024-01-15'")
add("s2_partitioned_ndjson", CAT_SPEC,
    lambda t: counted(bronze.read_ndjson(t.spark, written_catalogue(t), CATALOGUE)), f"SELECT *, {_N} FROM m_catalogue")
add("t4_union_of_files", CAT_SPEC,
    lambda t: counted(bronze.read_ndjson(t.spark, written_catalogue(t), CATALOGUE)), f"SELECT *, {_N} FROM m_catalogue")


def file_sizes(t: Inputs):
    """Records of a capped write by folder: full files, and what is left over in a short one. A folder is one task's here."""
    cap = bronze.CATALOGUE_RECORDS_PER_FILE
    stored = bronze.read_ndjson(t.spark, written_catalogue(t, cap), CATALOGUE).withColumn("file", F.input_file_name())
    per_file = stored.groupBy("extracted_date", "run_time", "file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("extracted_date", "run_time").agg(
        F.sum("n").alias("n_records"), F.count_if(F.col("n") == cap).alias("n_full"), F.count_if(F.col("n") != cap).alias("n_short"), F.max("n").alias("largest"))


add("s3_records_per_file", f"{RUN_SPEC} n_records:l n_full:l n_short:l largest:l", file_sizes,
    f"""SELECT *, n_records // {bronze.CATALOGUE_RECORDS_PER_FILE} AS n_full, CAST(n_records % {bronze.CATALOGUE_RECORDS_PER_FILE} > 0 AS BIGINT) AS n_short,
        LEAST(n_records, {bronze.CATALOGUE_RECORDS_PER_FILE}) AS largest
        FROM (SELECT extracted_date, run_time, COUNT(*) AS n_records FROM m_catalogue GROUP BY 1, 2)""")


def second_run_skipped(t: Inputs):
    """Write days only if they are not there: the second run writes nothing."""
    root = f"{t.scratch()}/catalogue"
    days = [str(r[0]) for r in t("catalogue_raw").select("extracted_date").distinct().orderBy("extracted_date").collect()]
    for run_time in ("07-30", "11-00"):
        missing = [day for day in days if not bronze.has_files(t.spark, root, day)]
        if missing:
            part = catalogue(t).drop("arrival").where(F.col("extracted_date").isin(missing)).withColumn("run_time", F.lit(run_time))
            bronze.write_ndjson(part, root, many_days=True)
    return counted(bronze.read_ndjson(t.spark, root, CATALOGUE))


def second_run_added(t: Inputs):
    """Forced runs stand side by side."""
    root = f"{t.scratch()}/catalogue"
    for run_time in ("07-30", "11-00"):
        bronze.write_ndjson(bronze.stamp(catalogue(t).drop("arrival"), "2024-01-15", run_time), root)
    return counted(bronze.read_ndjson(t.spark, root, CATALOGUE, "2024-01-15"))


_STAMPED = "SELECT * REPLACE (DATE '2024-01-15' AS extracted_date, '{0}' AS run_time), len(runners) AS n_runners FROM m_catalogue"
add("s4_idempotent_write", CAT_SPEC, second_run_skipped,
    "SELECT * REPLACE ('07-30' AS run_time), len(runners) AS n_runners FROM m_catalogue")
add("s5_forced_run", CAT_SPEC, second_run_added, f"{_STAMPED.format('07-30')} UNION ALL {_STAMPED.format('11-00')}")
add("s19_registered_table", CAT_SPEC,
    lambda t: counted(_stored(t, catalogue(t).drop("arrival"), RUN)), f"SELECT *, {_N} FROM m_catalogue")
add("s21_run_audit", f"{RUN_SPEC} success:l failed:l",
    lambda t: audit.run_counts(markets.gated_catalogue(t("catalogue_raw"), KEEP), RUN),
    """SELECT extracted_date, run_time, SUM(ok) AS success, SUM(1 - ok) AS failed FROM (
       SELECT extracted_date, run_time, 1 AS ok FROM m_catalogue UNION ALL SELECT extracted_date, run_time, 0 FROM m_cat_rejected)
       GROUP BY 1, 2""")


def _stored(t: Inputs, df, partition_by=()):
    folder = t.scratch()
    # VARIANT columns are stored as JSON text: tables stay readable for every parquet reader.
    flat = df.withColumn("runners", F.transform("runners", lambda e: F.to_json(e)))
    return tables.as_table(flat, f"furlong_{folder[-12:]}", folder, partition_by)


# ---------------------------------------------------------------- projections, filters
add("p9_flatten_market", f"arrival:l {_spec(CATALOGUE)}", catalogue, "SELECT * FROM m_catalogue")
add("p10_known_fields_only", f"arrival:l {_spec(BOOK)}", all_books, "SELECT * FROM m_book_all")
add("p17_run_stamp", "event_id:l extracted_date:d run_time",
    lambda t: t("events").select("event_id", dates.local_day(F.col("ts")).alias("extracted_date"), dates.run_time_stamp(F.col("ts")).alias("run_time")),
    """SELECT event_id, CAST(s AS DATE) AS extracted_date, strftime(s, '%H-%M') AS run_time
       FROM (SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney' AS s FROM events)""")
add("f3_catalogue_rejects", "arrival:l", lambda t: rejected(markets.gated_catalogue(t("catalogue_raw"), KEEP), KEEP),
    "SELECT arrival FROM m_cat_rejected")
add("f4_book_gate", "arrival:l marketId", all_books, "SELECT arrival, marketId FROM m_book_all")
add("f5_market_filter", "arrival:l market_id",
    lambda t: markets.wanted_records(landing.records(t("catalogue_raw"), KEEP)).where("record IS NOT NULL")
    .select("arrival", F.try_variant_get("record", "$.marketId", "string").alias("market_id")),
    "SELECT arrival, j ->> '$.marketId' AS market_id FROM m_cat_wanted")
add("f6_start_time_range", "market_id market_start_time",
    lambda t: catalogue(t).where(dates.starts_within_day(F.col("market_start_time"), F.lit("2024-01-15").cast("date"))),
    """SELECT market_id, market_start_time FROM m_catalogue WHERE CAST(REPLACE(REPLACE(market_start_time, 'T', ' '), '.000Z', '') AS TIMESTAMP)
       BETWEEN TIMESTAMP '2024-01-14 13:00:00' AND TIMESTAMP '2024-01-15 12:59:59'""")
add("f7_ids_present", "market_id arrival:l",
    lambda t: catalogue(t).withColumn("market_id", F.when(F.col("arrival") % 10 != 0, F.col("market_id")).otherwise("")).where(has_text(F.col("market_id"))),
    "SELECT market_id, arrival FROM m_catalogue WHERE arrival % 10 <> 0")
MAX_MARKETS = 200  # fixed value: markets per request of the catalogue service
add("t1_first_to_start", f"{RUN_SPEC} market_id market_start_time",
    lambda t: markets.first_to_start(catalogue(t), ["extracted_date"], MAX_MARKETS),
    """SELECT extracted_date, run_time, market_id, market_start_time FROM m_catalogue
       QUALIFY ROW_NUMBER() OVER (PARTITION BY extracted_date ORDER BY market_start_time, market_id) <= 200""")
add("t2_head", "market_id market_start_time", lambda t: markets.first_to_start(catalogue(t), [], 5),
    "SELECT market_id, market_start_time FROM m_catalogue ORDER BY market_start_time, market_id LIMIT 5")

# ---------------------------------------------------------------- keys, joins, windows
add("a10_distinct_market_ids", "market_id first_seen:l",
    lambda t: keyed.distinct_in_order(all_books(t).withColumnRenamed("marketId", "market_id"), "market_id", "arrival"),
    "SELECT marketId AS market_id, MIN(arrival) AS first_seen FROM m_book_all GROUP BY 1")
add("j9_book_of_catalogue", f"{RUN_SPEC} marketId status", book, "SELECT extracted_date, run_time, marketId, status FROM m_book")
add("w4_latest_book", f"{RUN_SPEC} marketId status totalMatched:f", lambda t: markets.latest_book(all_books(t)),
    "SELECT * FROM m_book_all QUALIFY ROW_NUMBER() OVER (PARTITION BY marketId ORDER BY extracted_date DESC, run_time DESC, arrival DESC) = 1")
add("latest_book", f"{RUN_SPEC} marketId status totalMatched:f", lambda t: markets.latest_book(all_books(t)),
    "SELECT * FROM m_book_all QUALIFY ROW_NUMBER() OVER (PARTITION BY marketId ORDER BY extracted_date DESC, run_time DESC, arrival DESC) = 1")
model("m_latest_book", "SELECT * FROM m_book_all QUALIFY ROW_NUMBER() OVER (PARTITION BY marketId ORDER BY extracted_date DESC, run_time DESC, arrival DESC) = 1")
model("m_latest_cat", "SELECT * FROM m_catalogue QUALIFY ROW_NUMBER() OVER (PARTITION BY market_id ORDER BY extracted_date DESC, run_time DESC, arrival DESC) = 1")
CATBOOK = "market_id market_name event_venue status book_matched:f selection_id:l runner_status last_price_traded:f"
_CATBOOK_SQL = """SELECT market_id, market_name, event_venue, status, totalMatched AS book_matched,
    CAST(e ->> '$.selectionId' AS BIGINT) AS selection_id, e ->> '$.status' AS runner_status,
    CAST(e ->> '$.lastPriceTraded' AS DOUBLE) AS last_price_traded
    FROM (SELECT c.market_id, c.market_name, c.event_venue, b.status, b.totalMatched,
                 UNNEST(CASE WHEN len(b.runners) > 0 THEN b.runners ELSE [NULL] END) AS e
          FROM m_latest_cat c JOIN m_latest_book b ON c.market_id = b.marketId)"""
for _key in ("j10_catalogue_book", "catalogue_book"):
    add(_key, CATBOOK, lambda t: markets.catalogue_book(catalogue(t), all_books(t)), _CATBOOK_SQL)
FLAT = "arrival:l market_id selection_id:l runner_name sort_priority:l"
_FLAT_SQL = """SELECT arrival, market_id, CAST(e ->> '$.selectionId' AS BIGINT) AS selection_id, e ->> '$.runnerName' AS runner_name,
    CAST(e ->> '$.sortPriority' AS BIGINT) AS sort_priority
    FROM (SELECT arrival, market_id, UNNEST(CASE WHEN len(runners) > 0 THEN runners ELSE [NULL] END) AS e FROM m_catalogue)"""
for _key in ("u1_flat_runners", "runners_flat"):
    add(_key, FLAT, lambda t: markets.flat_runners(catalogue(t), markets.CATALOGUE_RUNNER, ("arrival", "market_id")), _FLAT_SQL)

# ---------------------------------------------------------------- scalar
add("x15_json_round_trip", "event_id:l k:l text",
    lambda t: t("events").select("event_id", F.from_json("props", "k bigint, missing string").alias("p"))
    .select("event_id", F.col("p.k").alias("k"), F.to_json("p", {"ignoreNullFields": "false"}).alias("text")),
    """SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, '{"k":' || (props ->> '$.k') || ',"missing":null}' AS text FROM events""")
add("x16_nested_get", "arrival:l event_venue competition_name",
    lambda t: landing.records(t("catalogue_raw"), KEEP).where("record IS NOT NULL").select(
        "arrival", F.try_variant_get("record", "$.event.venue", "string").alias("event_venue"),
        F.try_variant_get("record", "$.competition.name", "string").alias("competition_name")),
    "SELECT arrival, j ->> '$.event.venue' AS event_venue, j ->> '$.competition.name' AS competition_name FROM m_cat_items")
add("x20_batch_number", "event_id:l batch:l",
    lambda t: number_by_position(t("events").select("event_id"), "event_id", "i", block=4096).withColumn(
        "batch", batch_number(F.col("i"), bronze.BOOK_RECORDS_PER_FILE)),
    "SELECT event_id, (ROW_NUMBER() OVER (ORDER BY event_id) - 1) // 8 AS batch FROM events")


# ---------------------------------------------------------------- streaming
def landed(t: Inputs, name: str, columns: list[str]) -> tuple[str, T.StructType]:
    """A proxy stored as NDJSON files, and its schema."""
    folder = f"{t.scratch()}/landed"
    df = t(name).select(*columns)
    df.write.option("ignoreNullFields", "false").json(folder)
    return folder, df.schema


def in_slices(df, column: str, n: int = 3) -> list:
    """The rows in n parts by ranges of a date or number column, which arrive one after another."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    cuts = [low + (high - low) * k // n for k in range(1, n)]
    edges = [F.lit(True), *(F.col(column) > c for c in cuts)]
    return [df.where(edges[k] & (~edges[k + 1] if k + 1 < n else F.lit(True))) for k in range(n)]


def streamed_bronze(t: Inputs):
    """Bronze files picked up as a stream into a parquet table."""
    root = written_catalogue(t)
    schema = T.StructType([f for f in with_partitions(CATALOGUE).fields if f.name != "runners"] + [T.StructField("runners", T.ArrayType(T.StringType()))])
    out = t.scratch()
    files.ingest(files.read_new(t.spark, root, schema), f"{out}/table", f"{out}/checkpoint", RUN).awaitTermination()
    return counted(t.spark.read.schema(schema).parquet(f"{out}/table"))


def streamed_ids(t: Inputs):
    """Markets per day as a stream; a day leaves the state some time after it."""
    folder, out = f"{t.scratch()}/landed", t.scratch()
    rows = t("book_raw").select("extracted_date", "arrival")
    for part in in_slices(rows, "extracted_date"):
        part.write.mode("append").json(folder)
        # Two snapshots per market share the market number, arrival div 2 up to the factor.
        stream = files.read_new(t.spark, folder, rows.schema).select(
            F.concat(F.lit("1."), F.floor((F.col("arrival") - 1) / 2).cast("string")).alias("market_id"), F.col("extracted_date").cast("timestamp").alias("day"))
        files.ingest(files.distinct_keys(stream, ["day", "market_id"], "day", "15 days"), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return t.spark.read.schema("market_id string, day timestamp").parquet(f"{out}/table")


def streamed_races(t: Inputs):
    """Race rows offered twice as a stream of files to the keyed table, in order of arrival.

    Each slice is a batch, or several; the first one that holds an id stores it, so the second offer adds nothing.
    """
    folder, out = f"{t.scratch()}/landed", t.scratch()
    offered = race_rows(t).drop("record_created_date", "extracted_at")
    for part in (*in_slices(offered, "arrival"), offered):
        part.write.mode("append").json(folder)
        stream = files.read_new(t.spark, folder, offered.schema)
        files.insert_new(stream, f"{out}/table", "race_id", ["arrival"], f"{out}/checkpoint", "meeting_date").awaitTermination()
    return read_keyed(t.spark, f"{out}/table", offered.schema)


def streamed_gate(t: Inputs):
    """Accepted and rejected records of the catalogue, from the two folders of the streaming gate."""
    folder, schema = landed(t, "catalogue_raw", ["arrival", "body"])
    out = t.scratch()
    files.gate_to(files.read_new(t.spark, folder, schema, files_per_batch=3), CATALOGUE, CATALOGUE_PATHS,
                  f"{out}/accepted", f"{out}/rejected", f"{out}/checkpoint", keep=("arrival",)).awaitTermination()
    passed = t.spark.read.schema("arrival bigint").json(f"{out}/accepted").select("arrival", F.lit(True).alias("passes"))
    failed = t.spark.read.schema("arrival bigint").json(f"{out}/rejected").select("arrival", F.lit(False).alias("passes"))
    return passed.unionByName(failed)


for _key in ("u2_incremental_ingest", "s18_incremental_ingest"):
    add(_key, CAT_SPEC, streamed_bronze, f"SELECT *, {_N} FROM m_catalogue")
add("u3_stream_distinct", "market_id day:d", streamed_ids, "SELECT DISTINCT '1.' || event_id AS market_id, CAST(ts AS DATE) AS day FROM events")
add("u4_stream_insert_or_ignore", f"{RACE_ROW} arrival:l", streamed_races, "SELECT * FROM m_history_rows")
add("u5_stream_gate", "arrival:l passes:b", streamed_gate,
    f"SELECT arrival, ({_cat_ok}) AS passes FROM m_cat_items UNION ALL SELECT arrival, FALSE FROM m_cat_unreadable")


# Streams in three batches by ranges of days. Rows of every tenth arrival come with the last batch, whatever their day.
STREAM_DELAY, LATE = 12, 3
_BATCH = f"CASE WHEN arrival % 10 = {LATE} THEN 2 ELSE CAST(extracted_date > lo + CAST((hi - lo) // 3 AS INT) AS INT) + CAST(extracted_date > lo + CAST((hi - lo) * 2 // 3 AS INT) AS INT) END"
_TIME = "CAST(extracted_date AS TIMESTAMP) + to_hours(CAST(SUBSTR(run_time, 1, 2) AS INT)) + to_minutes(CAST(SUBSTR(run_time, 4, 2) AS INT))"
model("m_days", "SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events")
model("m_cat_stream", f"SELECT *, {_BATCH} AS batch, {_TIME} AS t FROM m_catalogue, m_days")
model("m_book_stream", f"SELECT *, {_BATCH} AS batch, {_TIME} AS t FROM m_book_all, m_days")
# What each batch drops: rows not after the newest time of the batches before, the older one of the two streams', less the delay.
model("m_watermark", f"""SELECT b.batch, LEAST((SELECT MAX(t) FROM m_cat_stream c WHERE c.batch < b.batch), (SELECT MAX(t) FROM m_book_stream k WHERE k.batch < b.batch))
    - INTERVAL {STREAM_DELAY} DAY AS w FROM (VALUES (0), (1), (2)) AS b(batch)""")


def in_batches(t: Inputs, name: str) -> list:
    """The landed responses in three parts: by ranges of days, the late ones with the last."""
    responses = t(name).select("extracted_date", "run_time", "arrival", "body")
    on_time = in_slices(responses.where(F.col("arrival") % 10 != LATE), "extracted_date")
    return [*on_time[:-1], on_time[-1].unionByName(responses.where(F.col("arrival") % 10 == LATE))]


def event_time():
    return F.to_timestamp(F.concat_ws(" ", F.col("extracted_date").cast("string"), F.col("run_time")), "yyyy-MM-dd HH-mm")


def streamed_catalogue_book(t: Inputs):
    """Catalogue and book of a market within a day, as a join of two streams; late rows are dropped and counted."""
    base = t.scratch()
    parts = {name: in_batches(t, name) for name in ("catalogue_raw", "book_raw")}
    with progress.watched(t.spark) as seen:
        for k in range(3):
            for name, batches in parts.items():
                batches[k].write.mode("append").json(f"{base}/{name}")
            landed = {name: files.read_new(t.spark, f"{base}/{name}", batches[0].schema) for name, batches in parts.items()}
            c = markets.catalogue(landed["catalogue_raw"], KEEP).select("market_id", "market_name", "event_venue", event_time().alias("listed_at"))
            b = accepted(markets.gated_book(landed["book_raw"], KEEP)).select(F.col("marketId").alias("market_id"), "status", "totalMatched", event_time().alias("booked_at"))
            joined = files.joined_in_time(c, b, "market_id", "listed_at", "booked_at", f"{STREAM_DELAY} days", "1 DAY")
            progress.finish(t.spark, files.ingest(joined, f"{base}/table", f"{base}/checkpoint"), seen, f"{base}/audit")
    late = progress.read_audit(t.spark, f"{base}/audit").agg(F.sum("late").alias("n_late"))
    schema = "market_id string, market_name string, event_venue string, listed_at timestamp, status string, totalMatched double, booked_at timestamp"
    return t.spark.read.schema(schema).parquet(f"{base}/table").join(late)


add("u_catalogue_book_stream", "market_id market_name event_venue listed_at:t status totalMatched:f booked_at:t n_late:l", streamed_catalogue_book,
    """SELECT c.market_id, c.market_name, c.event_venue, c.t AS listed_at, b.status, b.totalMatched, b.t AS booked_at, l.n AS n_late
       FROM (SELECT c.* FROM m_cat_stream c JOIN m_watermark USING (batch) WHERE w IS NULL OR c.t > w) c
       JOIN (SELECT b.* FROM m_book_stream b JOIN m_watermark USING (batch) WHERE w IS NULL OR b.t > w) b
         ON c.market_id = b.marketId AND b.t >= c.t AND b.t <= c.t + INTERVAL 1 DAY,
       (SELECT COUNT(*) AS n FROM (SELECT batch, t FROM m_cat_stream UNION ALL SELECT batch, t FROM m_book_stream) JOIN m_watermark USING (batch) WHERE t <= w) l""")


def streamed_latest_book(t: Inputs):
    """The newest snapshot per market, kept by a stream whose batches come out of order."""
    base, order = t.scratch(), ("extracted_date", "run_time", "arrival")
    parts = in_batches(t, "book_raw")
    for k in (2, 0, 1):
        parts[k].write.mode("append").json(f"{base}/landed")
        books = accepted(markets.gated_book(files.read_new(t.spark, f"{base}/landed", parts[k].schema), KEEP))
        files.keep_latest(books, "marketId", order, ("status", "totalMatched"), f"{base}/table", f"{base}/checkpoint").awaitTermination()
    schema = T.StructType([T.StructField("marketId", T.StringType()), *(books.schema[c] for c in (*order, "status", "totalMatched"))])
    compact_latest(t.spark, f"{base}/table", schema, "marketId", order)
    return read_latest(t.spark, f"{base}/table", schema, "marketId", order)


add("w4_latest_book_stream", f"{RUN_SPEC} arrival:l marketId status totalMatched:f", streamed_latest_book, "SELECT * FROM m_latest_book")


def streamed_within(t: Inputs):
    """Markets of both snapshots, distinct within the delay: what was offered, written, dropped as a duplicate and as late."""
    base = t.scratch()
    with progress.watched(t.spark) as seen:
        for part in in_batches(t, "book_raw"):
            part.select("extracted_date", "run_time", "arrival").write.mode("append").json(f"{base}/landed")
            stream = files.read_new(t.spark, f"{base}/landed", T.StructType([f for f in part.schema if f.name != "body"]))
            ids = stream.select(F.floor((F.col("arrival") - 1) / 2).alias("event_id"), event_time().alias("at"))
            kept = files.distinct_within(ids, ["event_id"], "at", f"{STREAM_DELAY} days")
            progress.finish(t.spark, files.ingest(kept, f"{base}/table", f"{base}/checkpoint"), seen, f"{base}/audit")
    counts = progress.read_audit(t.spark, f"{base}/audit").agg(F.sum("offered").alias("offered"), F.sum("duplicates").alias("duplicates"), F.sum("late").alias("late"))
    written = t.spark.read.schema("event_id long").parquet(f"{base}/table").agg(F.count("event_id").alias("written"), F.countDistinct("event_id").alias("markets"))
    return counts.join(written).withColumn("whole", F.col("written") + F.col("duplicates") + F.col("late") == F.col("offered"))


_OFFERED = f"SELECT CAST(FLOOR((arrival - 1) / 2) AS BIGINT) AS event_id, {_BATCH} AS batch, {_TIME} AS t FROM book_raw, m_days"
add("u3_distinct_within", "offered:l written:l markets:l duplicates:l late:l whole:b", streamed_within,
    f"""WITH o AS ({_OFFERED}), w AS (SELECT b.batch, (SELECT MAX(t) FROM o WHERE o.batch < b.batch) - INTERVAL {STREAM_DELAY} DAY AS w FROM (VALUES (0), (1), (2)) AS b(batch)),
        n AS (SELECT event_id, COALESCE(t <= w, FALSE) AS late FROM o JOIN w USING (batch))
        SELECT COUNT(*) AS offered, COUNT(DISTINCT event_id) FILTER (NOT late) AS written, COUNT(DISTINCT event_id) FILTER (NOT late) AS markets,
               COUNT(*) FILTER (NOT late) - COUNT(DISTINCT event_id) FILTER (NOT late) AS duplicates, COUNT(*) FILTER (late) AS late, TRUE AS whole FROM n""")


def streamed_gate_counts(t: Inputs):
    """Accepted and rejected records of each batch of the streaming gate, from its audit."""
    base = t.scratch()
    for part in in_batches(t, "catalogue_raw"):
        part.write.mode("append").json(f"{base}/landed")
        files.gate_to(files.read_new(t.spark, f"{base}/landed", part.schema), CATALOGUE, CATALOGUE_PATHS, f"{base}/accepted", f"{base}/rejected",
                      f"{base}/checkpoint", keep=("arrival",), audit=f"{base}/audit").awaitTermination()
    return t.spark.read.schema("batch_id long, success long, failed long").json(f"{base}/audit")


add("u5_batch_counts", "batch_id:l success:l failed:l", streamed_gate_counts,
    f"""SELECT batch AS batch_id, COUNT(*) FILTER (ok) AS success, COUNT(*) FILTER (NOT ok) AS failed FROM (
        SELECT {_BATCH} AS batch, ok FROM (SELECT extracted_date, arrival, ({_cat_ok}) AS ok FROM m_cat_items UNION ALL SELECT extracted_date, arrival, FALSE FROM m_cat_unreadable), m_days) GROUP BY 1""")


# ---------------------------------------------------------------- schema drift
DRIFTING = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
# From the second third of the ids on some lines have a new key, in the last third some values are no numbers.
_DRIFT = """SELECT event_id, event_type, value, third >= 1 AND event_id % 5 = 0 AS more, third = 2 AND event_id % 7 = 0 AS bad, third
    FROM (SELECT event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value,
          CAST(event_id > lo + CAST(FLOOR((hi - lo) / 3) AS BIGINT) AS INT) + CAST(event_id > lo + CAST(FLOOR((hi - lo) * 2 / 3) AS BIGINT) AS INT) AS third
          FROM {events} CROSS JOIN (SELECT MIN(event_id) AS lo, MAX(event_id) AS hi FROM {events}))"""
model("m_drift", _DRIFT.format(events="events"))


def drifted(t: Inputs) -> str:
    """Folder with the table and the log of a stream of lines that change on the way, in three batches."""
    base = t.scratch()
    rows = t.spark.sql(_DRIFT, events=t("events"))
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "event_type": "'), F.col("event_type"), F.lit('", "value": '),
                    F.when(F.col("bad"), '"n/a"').otherwise(F.col("value").cast("string")), F.when(F.col("more"), ', "channel": "web"').otherwise(""), F.lit("}"))
    for k in range(3):
        rows.where(F.col("third") == k).select(line.alias("value")).write.mode("append").text(f"{base}/landed")
        drift.ingest_rescued(drift.read_lines(t.spark, f"{base}/landed"), DRIFTING, f"{base}/table", f"{base}/log", f"{base}/checkpoint").awaitTermination()
    return base


def drifted_rows(t: Inputs):
    schema = T.StructType([*DRIFTING.fields, T.StructField("rescued", T.VariantType())])
    return t.spark.read.schema(schema).parquet(f"{drifted(t)}/table").withColumn("rescued", F.to_json("rescued"))


add("s18_schema_drift", "event_id:l event_type value:f rescued", drifted_rows,
    """SELECT event_id, event_type, CASE WHEN NOT bad THEN value END AS value, CASE WHEN more AND bad THEN '{"channel":"web","value":"n/a"}'
       WHEN more THEN '{"channel":"web"}' WHEN bad THEN '{"value":"n/a"}' END AS rescued FROM m_drift""")
add("s18_schema_log", "batch_id:l key type n:l", lambda t: drift.read_log(t.spark, f"{drifted(t)}/log"),
    """SELECT third AS batch_id, 'channel' AS key, 'STRING' AS type, COUNT(*) AS n FROM m_drift WHERE more GROUP BY 1
       UNION ALL SELECT third, 'value', 'STRING', COUNT(*) FROM m_drift WHERE bad GROUP BY 1""")


# ---------------------------------------------------------------- the run
def bronze_days(t: Inputs, plan: list[tuple[str, bool]]):
    """Runs of both feeds, each at half past one UTC of its day, as (day, forced): what they report and what is stored.

    ``failed`` is as reported by the run that wrote last, ``stored`` and ``quarantined`` are counted in the folders.
    """
    base = t.scratch()
    paths = bronze_run.BronzePaths(f"{base}/catalogue", f"{base}/book", f"{base}/quarantine")
    reported = {}
    for day, forced in plan:
        now = datetime.fromisoformat(f"{day}T01:30:00+00:00")
        done = bronze_run.run("all", t("catalogue_raw"), t("book_raw"), paths, day, now, overwrite=forced)
        if not any(r.skipped for r in done.values()):
            reported[day] = bronze_run.results_table(t.spark, done, day, now)

    def sizes(folder: str, name: str):
        per_feed = [
            t.spark.read.schema("extracted_date date, run_time string").option("basePath", f"{folder}{feed}").json(f"{folder}{feed}").withColumn("feed", F.lit(feed))
            for feed in ("catalogue", "book")
        ]
        return per_feed[0].unionByName(per_feed[1]).groupBy("feed", *RUN).agg(F.count(F.lit(1)).alias(name))

    results = reduce(lambda a, b: a.unionByName(b), reported.values())
    on = ["feed", *RUN]
    return results.join(sizes(f"{base}/", "stored"), on, "full").join(sizes(f"{paths.quarantine}/", "quarantined"), on, "full").fillna(0, ["stored", "quarantined"])


def _days_sql(days: list[str]) -> str:
    """What the runs of the days must report and store."""
    parts = []
    for day in days:
        start = (datetime.fromisoformat(day) - timedelta(days=1)).strftime("%Y-%m-%d")
        cat = f"FROM m_catalogue WHERE extracted_date = DATE '{day}' AND market_start_time BETWEEN '{start}T13:00:00.000Z' AND '{day}T12:59:59.999Z'"
        good_books = f"FROM m_book_all WHERE extracted_date = DATE '{day}' AND marketId IN (SELECT market_id {cat})"
        bad_books = f"FROM m_book_items WHERE extracted_date = DATE '{day}' AND NOT ({_book_ok})"
        for feed, good, bad in (("catalogue", cat, f"FROM m_cat_rejected WHERE extracted_date = DATE '{day}'"), ("book", good_books, bad_books)):
            parts.append(f"SELECT '{feed}' AS feed, DATE '{day}' AS extracted_date, '12-30' AS run_time, (SELECT COUNT(*) {good}) AS n, (SELECT COUNT(*) {bad}) AS k")
    return f"SELECT feed, extracted_date, run_time, n AS success, k AS failed, n AS stored, k AS quarantined FROM ({' UNION ALL '.join(parts)})"


DAY_SPEC = f"feed {RUN_SPEC} success:l failed:l stored:l quarantined:l"
# A run, then the same again: the second one is skipped.
add("bronze_run_of_a_day", DAY_SPEC, lambda t: bronze_days(t, [("2024-01-15", False), ("2024-01-15", False)]), _days_sql(["2024-01-15"]))
# Two days, and the first once more, forced in the same minute: it replaces its own rows and no others.
add("bronze_run_of_two_days", DAY_SPEC, lambda t: bronze_days(t, [("2024-01-15", False), ("2024-01-16", False), ("2024-01-15", True)]),
    _days_sql(["2024-01-15", "2024-01-16"]))
