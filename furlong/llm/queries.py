"""The operators over the driver's tables: one query each, with the SQL that it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.llm import bpe, decontamination, langid, licenses, negatives, periodic, resampling, rules, simhash, substring, token_counts, toxicity, url_filter
from furlong.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.length_histogram(table(spark, sf_dir, "documents")))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = simhash.components(table(spark, sf_dir, "documents"))
    return done.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


@query
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched on a day of 2024 that their id gives; list entries are dated by hashes of hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(366)) * 86400))
    hosts = pages.select(url_filter.host_of("url").alias("pattern")).where("pattern <> ''").distinct()
    names = hosts.select("pattern").union(hosts.select(F.substring_index("pattern", ".", -2))).union(hosts.select(F.substring_index("pattern", ".", -3))).distinct()
    digit = lambda k: F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(F.col("pattern").cast("binary")), k, 1))
    day = lambda n: F.timestamp_seconds(F.lit(1704067200) + n * 86400)
    dated = [("add", 12 * digit(2)), ("remove", 12 * digit(2) + 5 * digit(3)), ("add", 12 * digit(2) + 5 * digit(3) + 9 * digit(4)), ("add", 12 * digit(2) + 3)]
    entries = names.where(digit(1) <= 6).select("pattern", F.explode(F.array(*(F.struct(F.lit(a).alias("action"), day(n).alias("at")) for a, n in dated))).alias("e")).select("pattern", "e.*")
    done = url_filter.evaluate(captures, entries)
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    return done.select("page_id", "host", iso("fetched_at").alias("fetched"), "blocked", "pattern", iso("listed_at").alias("listed"))


SQL["op5_url_filters"] = r"""
WITH page AS (
    SELECT page_id, regexp_extract(regexp_replace(regexp_extract(lower(trim(coalesce(url, ''))), '^[a-z][a-z0-9+.-]*://([^/?#\\]*)', 1), '^.*@', ''), '^(\[[^\]]*\]|[^:]*?)\.*(?::.*)?$', 1) AS host,
        TIMESTAMP '2024-01-01' + to_days(CAST(coalesce(page_id, 0) % 366 AS INTEGER)) AS fetched_at
    FROM pages),
part AS (SELECT DISTINCT string_split(host, '.') AS p FROM page WHERE host <> ''),
name AS (
    SELECT array_to_string(p, '.') AS pattern FROM part UNION SELECT array_to_string(p[-2:], '.') FROM part
    UNION SELECT array_to_string(p[-3:], '.') FROM part),
digit AS (
    SELECT pattern, instr('0123456789abcdef', md5(pattern)[2]) AS d2, instr('0123456789abcdef', md5(pattern)[3]) AS d3, instr('0123456789abcdef', md5(pattern)[4]) AS d4
    FROM name WHERE instr('0123456789abcdef', md5(pattern)[1]) <= 6),
entry AS (
    SELECT pattern, 1 AS adds, 12 * d2 AS day FROM digit UNION ALL SELECT pattern, 0, 12 * d2 + 5 * d3 FROM digit
    UNION ALL SELECT pattern, 1, 12 * d2 + 5 * d3 + 9 * d4 FROM digit UNION ALL SELECT pattern, 1, 12 * d2 + 3 FROM digit),
once AS (SELECT pattern, TIMESTAMP '2024-01-01' + to_days(CAST(day AS INTEGER)) AS at, max(adds) AS adds FROM entry GROUP BY ALL),
ask AS (SELECT DISTINCT host, fetched_at FROM page WHERE host <> ''),
keyed AS (
    SELECT host, fetched_at, array_to_string(p[k:], '.') AS pattern
    FROM (SELECT host, fetched_at, string_split(host, '.') AS p, unnest(range(1, len(string_split(host, '.')) + 1)) AS k FROM ask)),
latest AS (
    SELECT k.host, k.fetched_at, k.pattern, arg_max(o.adds, o.at) AS adds FROM keyed k JOIN once o ON o.pattern = k.pattern AND o.at <= k.fetched_at GROUP BY ALL),
longest AS (SELECT host, fetched_at, arg_max(pattern, length(pattern)) AS pattern FROM latest WHERE adds = 1 GROUP BY ALL),
since AS (
    SELECT l.host, l.fetched_at, l.pattern, min(o.at) AS listed_at FROM longest l JOIN once o ON o.pattern = l.pattern AND o.at <= l.fetched_at AND o.adds = 1
    WHERE o.at > coalesce((SELECT max(r.at) FROM once r WHERE r.pattern = l.pattern AND r.adds = 0 AND r.at <= l.fetched_at), TIMESTAMP '1900-01-01') GROUP BY ALL)
SELECT p.page_id, p.host, strftime(p.fetched_at, '%Y-%m-%d') AS fetched, s.pattern IS NOT NULL AS blocked, s.pattern, strftime(s.listed_at, '%Y-%m-%d') AS listed
FROM page p LEFT JOIN since s ON s.host = p.host AND s.fetched_at = p.fetched_at
"""


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    target = resampling.labelled(docs, table(spark, sf_dir, "labels"), "quality").where("label = 1")
    return resampling.resample(docs, target)


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = langid.train(docs.where(~held_out(F.col("doc_id"))))
    return langid.predict(docs, filters).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    crf = rules.train(resampling.labelled(docs, table(spark, sf_dir, "labels"), "quality", rules.TRAIN_ROWS))
    return rules.judge(docs, crf)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic.looped(F.col("doc_id"), F.col("text")).alias("text"))
    done = periodic.find(docs)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    # The longest run: by length, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = done.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


SQL["op13_hard_negatives"] = """
WITH part AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
score AS (
    SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS s
    FROM part a JOIN part r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positive AS (
    SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM score WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, s AS negative_score
FROM positive JOIN (SELECT * FROM score WHERE NOT same) USING (anchor_id)
WHERE 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score
QUALIFY rank <= 10
"""
