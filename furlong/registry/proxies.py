"""Input tables of the models, derived from the driver's tables.

Each derivation is one SQL text in the subset that Spark and DuckDB share, so both sides of a
comparison start from the same rows. ``{name}`` stands for a driver table or another proxy.
Rows are mapped, never filtered: where a model needs unmatched keys, some keys are moved.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from furlong.functions.tracks import TRACK_CODES

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Course slugs for the race proxies: all mapped ones and some without a code. The first two
# unmapped ones share their fallback code with a mapped course.
UNMAPPED_SLUGS = ("benalla", "mortlake", "avoca", "cessnock", "eidsvold", "roma", "york-park", "zeehan")
SLUGS = (*TRACK_CODES, *UNMAPPED_SLUGS)

_slug_rows = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SLUGS))


def _iso(ts: str) -> str:
    """ISO text of a timestamp, whole seconds, UTC."""
    text = f"CAST(DATE_TRUNC('second', {ts}) AS STRING)"
    return f"CONCAT(SUBSTR({text}, 1, 10), 'T', SUBSTR({text}, 12, 8), '.000Z')"


PROXIES = {
    # ------------------------------------------------------------ shop
    "raw_customers": "SELECT c_custkey AS id, c_name AS name FROM {customer}",
    # Customers with a key ending in 3 have no orders; theirs go to the next key.
    "raw_orders": """
        SELECT o_orderkey AS id, CAST(o_custkey % 25 AS BIGINT) AS store_id,
               CASE WHEN o_custkey % 10 = 3 THEN o_custkey + 1 ELSE o_custkey END AS customer,
               CAST(ROUND(o_totalprice * 100) AS BIGINT) AS subtotal,
               CAST(FLOOR(ROUND(o_totalprice * 100) / 14) AS BIGINT) AS tax_paid,
               CAST(ROUND(o_totalprice * 100) AS BIGINT)
                 + CAST(FLOOR(ROUND(o_totalprice * 100) / 14) AS BIGINT) AS order_total,
               o_orderdate AS ordered_at
        FROM {orders}""",
    # Items of every 13th supplier name an order that does not exist.
    "raw_items": """
        SELECT CONCAT(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
                      CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS id,
               CASE WHEN l_suppkey % 13 = 0 THEN -l_orderkey - 1 ELSE l_orderkey END AS order_id,
               l_partkey AS sku
        FROM {lineitem}""",
    "raw_products": """
        SELECT p_partkey AS sku, p_name AS name,
               CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'jaffle'
                    WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'beverage'
                    WHEN p_type = 'PROMO' THEN NULL ELSE 'other' END AS type,
               p_brand AS description, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS price
        FROM {part}""",
    # Supplies of every 7th part name a product that does not exist.
    "raw_supplies": """
        SELECT DISTINCT l_suppkey AS id,
               CASE WHEN l_partkey % 7 = 0 THEN -l_partkey - 1 ELSE l_partkey END AS sku,
               CONCAT('S', CAST(l_suppkey AS STRING)) AS name,
               (l_suppkey * 37 + l_partkey * 11) % 5000 + 1 AS cost,
               l_suppkey % 2 = 0 AS perishable
        FROM {lineitem}""",
    "raw_stores": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
               CAST(n_regionkey AS DOUBLE) * 0.01E0 AS tax_rate,
               CAST(DATE '2016-09-01' + n_nationkey AS TIMESTAMP) + INTERVAL '86399' SECOND AS opened_at
        FROM {nation}""",
    # ------------------------------------------------------------ racing, Silver
    "silver_runners": """
        SELECT CONCAT('T', CAST(l_orderkey % 97 AS STRING)) AS track,
               CAST(FLOOR(l_orderkey / 97) % 10 + 1 AS INT) AS race_number,
               DATE '2000-01-01' + CAST(FLOOR(l_orderkey / 970) AS INT) AS race_date,
               CONCAT('R', CAST(l_orderkey AS STRING)) AS race_name,
               CAST(1000 + l_orderkey % 20 * 100 AS INT) AS distance_m,
               CONCAT('C', CAST(l_orderkey % 6 AS STRING)) AS race_class,
               CASE WHEN l_orderkey % 3 = 0 THEN 'Good' WHEN l_orderkey % 3 = 1 THEN 'Soft' END AS track_condition,
               CONCAT('H', CAST(l_partkey AS STRING)) AS horse_name,
               CONCAT('J', CAST(l_suppkey AS STRING)) AS jockey,
               CONCAT('N', CAST(l_partkey % 50 AS STRING)) AS trainer,
               l_linenumber AS barrier, l_quantity AS weight_kg,
               CAST(l_partkey % 40 AS INT) AS overall_starts, CAST(l_partkey % 7 AS INT) AS overall_wins,
               l_discount AS overall_win_pct,
               CASE WHEN l_returnflag = 'R' THEN TRUE
                    WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN NULL ELSE FALSE END AS scratched
        FROM {lineitem}""",
    # ------------------------------------------------------------ racing, landed responses
    "course_slugs": f"SELECT i, slug FROM (VALUES {_slug_rows}) AS t(i, slug)",
    "form_raw": f"""
        SELECT CAST(DATE_TRUNC('quarter', o_orderdate) AS DATE) AS meeting_date,
               CASE WHEN o_orderkey % 2 = 0 THEN slug ELSE UPPER(slug) END AS track,
               CAST(o_orderkey % 12 + 1 AS INT) AS race_num,
               CAST(CASE WHEN o_orderkey % 17 = 0 THEN 404 ELSE 200 END AS INT) AS http_status,
               CASE WHEN o_orderkey % 101 = 0 THEN 'Bad gateway' ELSE
               CONCAT('{{{{',
                 CASE WHEN o_orderkey % 37 = 0 THEN '"raceName": null, '
                      WHEN o_orderkey % 41 = 0 THEN ''
                      ELSE CONCAT('"raceName": "Race of ', o_orderpriority, ' ', REPEAT('x', CAST(o_orderkey % 120 AS INT)), '", ') END,
                 CASE WHEN o_orderkey % 23 = 0 THEN ''
                      WHEN o_orderkey % 29 = 0 THEN '"prizeMoney": "N/A", '
                      WHEN o_orderkey % 43 = 0 THEN '"prizeMoney": "", '
                      ELSE CONCAT('"prizeMoney": "$', CAST(CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS STRING), ',',
                                  LPAD(CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0'), '", ') END,
                 '"distance": "', CAST(1000 + o_custkey % 20 * 100 AS STRING),
                 CASE WHEN o_orderkey % 31 = 0 THEN ' metres", ' ELSE 'm", ' END,
                 '"raceClass": "', o_orderstatus, '", "date": "', SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10),
                 '", "condition": "', o_orderpriority, '", "numberOfRunners": ', CAST(o_custkey % 12 + 1 AS STRING), '}}}}')
               END AS body,
               o_orderkey AS arrival
        FROM {{orders}} JOIN {{course_slugs}} ON o_custkey % {len(SLUGS)} = i""",
    # One response per order with two meetings; the second has no slug.
    "meetings_raw": f"""
        SELECT CAST(o_orderdate AS DATE) AS meeting_date,
               CAST(CASE WHEN o_orderkey % 19 = 0 THEN 500 ELSE 200 END AS INT) AS http_status,
               CASE WHEN o_orderkey % 53 = 0 THEN '{{{{}}}}'
                    ELSE CONCAT('{{{{"meetings": [{{{{"slug": "', slug, '", "track": "A', o_orderstatus, '"}}}}, {{{{"slug": "", "track": "B',
                                CAST(o_custkey AS STRING), '"}}}}]}}}}') END AS body
        FROM {{orders}} JOIN {{course_slugs}} ON o_custkey % {len(SLUGS)} = i""",
    # ------------------------------------------------------------ Bronze, landed responses
    # One response per event: its market and, for every third event, the place market with it.
    "catalogue_raw": f"""
        SELECT CAST(ts AS DATE) AS extracted_date,
               CASE WHEN event_id % 2 = 0 THEN '07-30' ELSE '11-00' END AS run_time,
               CASE WHEN event_id % 71 = 0 THEN 'upstream timeout' ELSE
               CONCAT('[{{{{"marketId": ', CASE WHEN event_id % 41 = 0 THEN CAST(event_id AS STRING)
                                          ELSE CONCAT('"1.', CAST(event_id AS STRING), '"') END,
                 ', "marketName": "R', CAST(event_id % 10 + 1 AS STRING), ' ', event_type, '"',
                 ', "marketStartTime": "', {_iso("ts")}, '"',
                 ', "totalMatched": ', CASE WHEN event_id % 43 = 0 THEN '"abc"'
                                            WHEN event_id % 7 = 0 THEN CONCAT('"', CAST(CAST(value AS DECIMAL(18,2)) AS STRING), '"')
                                            ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END,
                 ', "eventType": {{{{"id": "7", "name": "Horse Racing"}}}}',
                 ', "event": {{{{"id": "', CAST(user_id AS STRING), '", "name": "Meeting ', CAST(user_id % 50 AS STRING),
                 '", "countryCode": "', CASE WHEN user_id % 4 = 0 THEN 'NZ' ELSE 'AU' END,
                 '", "timezone": "Australia/Sydney", "venue": "', event_type, '", "openDate": "', {_iso("ts")}, '"}}}}',
                 CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 11 = 0 THEN ', "competition": null'
                      ELSE CONCAT(', "competition": {{{{"id": "', CAST(event_id % 20 AS STRING), '", "name": "Cup ', CAST(event_id % 20 AS STRING), '"}}}}') END,
                 ', "description": {{{{"bettingType": "ODDS", "marketType": "WIN", "eachWayDivisor": ',
                 CASE WHEN event_id % 6 = 0 THEN '4' ELSE '"4.5"' END,
                 ', "turnInPlayEnabled": ', CASE WHEN event_id % 3 = 0 THEN '"yes"' WHEN event_id % 13 = 0 THEN '7' ELSE 'true' END,
                 ', "rules": "Rule ', CAST(event_id % 100 AS STRING), '"}}}}',
                 ', "runners": ', CASE WHEN event_id % 47 = 0 THEN '[1]' WHEN event_id % 53 = 0 THEN 'null'
                                       WHEN event_id % 59 = 0 THEN CONCAT('[{{{{"selectionId": ', CAST(user_id AS STRING), '}}}}, null]')
                                       WHEN event_id % 61 = 0 THEN '[]'
                                       ELSE CONCAT('[{{{{"selectionId": ', CAST(user_id AS STRING), ', "runnerName": "A", "sortPriority": 1}}}}, {{{{"selectionId": ',
                                                   CAST(user_id + 1 AS STRING), ', "runnerName": "B", "sortPriority": 2}}}}]') END,
                 ', "unknownField": 1}}}}',
                 CASE WHEN event_id % 3 = 0 THEN CONCAT(', {{{{"marketId": "2.', CAST(event_id AS STRING),
                      '", "marketStartTime": "', {_iso("ts")},
                      '", "eventType": {{{{"id": "7"}}}}, "event": {{{{"countryCode": "AU"}}}}, "description": {{{{"marketType": "PLACE"}}}}}}}}')
                      ELSE '' END,
                 ']') END AS body,
               event_id AS arrival
        FROM {{events}}""",
    # Two snapshots per market: before and after the race.
    "snapshots": """
        SELECT *, '11-00' AS run_time, 'OPEN' AS status, 1 AS factor FROM {events}
        UNION ALL SELECT *, '23-30' AS run_time, 'CLOSED' AS status, 2 AS factor FROM {events}""",
    "book_raw": """
        SELECT CAST(ts AS DATE) AS extracted_date, run_time,
               CONCAT('[{{"marketId": "1.', CAST(event_id AS STRING), '", "status": "', status, '"',
                 ', "totalMatched": ', CASE WHEN event_id % 29 = 0 THEN 'true' WHEN event_id % 31 = 0 THEN '{{}}'
                                            ELSE CAST(CAST(value * factor AS DECIMAL(18,2)) AS STRING) END,
                 ', "totalAvailable": "', CAST(user_id AS STRING), '.5"',
                 ', "runners": ', CASE WHEN event_id % 61 = 0 THEN '[]'
                      ELSE CONCAT('[{{"selectionId": ', CAST(user_id AS STRING), ', "status": "ACTIVE", "lastPriceTraded": 3.5}}]') END,
                 ', "isMarketDataDelayed": ', CASE WHEN event_id % 37 = 0 THEN '"off"' WHEN event_id % 67 = 0 THEN '"maybe"' ELSE 'false' END,
                 ', "betDelay": ', CASE WHEN event_id % 23 = 0 THEN '1.5' WHEN event_id % 19 = 0 THEN '"2"' WHEN event_id % 17 = 0 THEN '5.0' ELSE '0' END,
                 ', "crossMatchingEnabled": 1, "runnersVoidable": 0',
                 ', "version": ', CAST(event_id * 1000003 + factor AS STRING), ', "complete": true}}]') AS body,
               event_id * 2 + factor AS arrival
        FROM {snapshots}""",
}

# Proxies that build JSON texts, from tables of one row group each: their rows are dealt out first, or one task builds all.
COSTLY = ("form_raw", "meetings_raw", "catalogue_raw", "snapshots")

_NAME = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def proxy_sql(name: str) -> str:
    """The derivation with plain names and single braces, as DuckDB runs it inside a WITH."""
    return _NAME.sub(r"\1", PROXIES[name]).replace("{{", "{").replace("}}", "}")


def needed(names: list[str] | tuple[str, ...]) -> list[str]:
    """The proxies behind ``names``, inputs first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in DRIVER_TABLES or name in order:
            return
        for parent in _NAME.findall(PROXIES[name]):
            visit(parent)
        order.append(name)

    for name in names:
        visit(name)
    return order


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a proxy as a DataFrame."""
    if name in DRIVER_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inputs = {parent: table(spark, sf_dir, parent) for parent in set(_NAME.findall(PROXIES[name]))}
    if name in COSTLY:
        inputs = {parent: df.repartition(spark.sparkContext.defaultParallelism) if parent in DRIVER_TABLES else df for parent, df in inputs.items()}
    return spark.sql(PROXIES[name], **inputs)
