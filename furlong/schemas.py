"""Table schemas.

Bronze catalogue and book records have every field nullable. ``runners`` stays an
array of free-form objects there, held as VARIANT, and is flattened in Silver.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


S, D, I, L, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()
DATE, TS = T.DateType(), T.TimestampType()
OBJECTS = T.ArrayType(T.VariantType())

# ---------------------------------------------------------------- shop, raw
RAW_CUSTOMERS = _struct(("id", L), ("name", S))
RAW_ORDERS = _struct(
    ("id", L), ("store_id", L), ("customer", L), ("subtotal", L), ("tax_paid", L),
    ("order_total", L), ("ordered_at", TS),
)
RAW_ITEMS = _struct(("id", S), ("order_id", L), ("sku", L))
RAW_PRODUCTS = _struct(("sku", L), ("name", S), ("type", S), ("description", S), ("price", L))
RAW_SUPPLIES = _struct(("id", L), ("sku", L), ("name", S), ("cost", L), ("perishable", B))
RAW_STORES = _struct(("id", L), ("name", S), ("tax_rate", D), ("opened_at", TS))

SHOP_RAW = {
    "raw_customers": RAW_CUSTOMERS,
    "raw_orders": RAW_ORDERS,
    "raw_items": RAW_ITEMS,
    "raw_products": RAW_PRODUCTS,
    "raw_supplies": RAW_SUPPLIES,
    "raw_stores": RAW_STORES,
}

# Column that dates a raw row, where one is declared.
LOADED_AT = {"raw_orders": "ordered_at", "raw_stores": "opened_at"}

# ---------------------------------------------------------------- racing
SILVER_RUNNERS = _struct(
    ("track", S), ("race_number", I), ("race_date", DATE), ("race_name", S), ("distance_m", I),
    ("race_class", S), ("track_condition", S), ("horse_name", S), ("jockey", S), ("trainer", S),
    ("barrier", I), ("weight_kg", D), ("overall_starts", I), ("overall_wins", I),
    ("overall_win_pct", D), ("scratched", B),
)

# Landed responses of the form service. `arrival` orders the responses.
MEETING_RESPONSES = _struct(("meeting_date", DATE), ("http_status", I), ("body", S))
FORM_RESPONSES = _struct(
    ("meeting_date", DATE), ("track", S), ("race_num", I), ("http_status", I), ("body", S),
    ("arrival", L),
)

RACE = _struct(
    ("race_id", S), ("race_name", S), ("short_race_name", S), ("meeting_id", S), ("venue", S),
    ("race_order", I), ("race_class", S), ("scheduled_date", DATE), ("race_status", S),
    ("distance_meters", I), ("race_condition", S), ("field_size", I), ("prize_total", D),
    ("record_created_date", TS), ("extracted_at", TS),
)

# ---------------------------------------------------------------- Bronze
CATALOGUE = _struct(
    ("market_id", S), ("market_name", S), ("market_start_time", S), ("total_matched", D),
    ("runners", OBJECTS), ("event_type_id", S), ("event_type_name", S), ("event_id", S),
    ("event_name", S), ("event_country", S), ("event_timezone", S), ("event_venue", S),
    ("event_open_date", S), ("competition_id", S), ("competition_name", S), ("betting_type", S),
    ("each_way_divisor", D), ("turn_in_play", B), ("rules", S),
)

# Where each flat catalogue column sits in the landed market object.
CATALOGUE_PATHS = {
    "market_id": "$.marketId",
    "market_name": "$.marketName",
    "market_start_time": "$.marketStartTime",
    "total_matched": "$.totalMatched",
    "runners": "$.runners",
    "event_type_id": "$.eventType.id",
    "event_type_name": "$.eventType.name",
    "event_id": "$.event.id",
    "event_name": "$.event.name",
    "event_country": "$.event.countryCode",
    "event_timezone": "$.event.timezone",
    "event_venue": "$.event.venue",
    "event_open_date": "$.event.openDate",
    "competition_id": "$.competition.id",
    "competition_name": "$.competition.name",
    "betting_type": "$.description.bettingType",
    "each_way_divisor": "$.description.eachWayDivisor",
    "turn_in_play": "$.description.turnInPlayEnabled",
    "rules": "$.description.rules",
}

BOOK = _struct(
    ("marketId", S), ("status", S), ("totalMatched", D), ("totalAvailable", D),
    ("runners", OBJECTS), ("isMarketDataDelayed", B), ("betDelay", I),
    ("crossMatchingEnabled", B), ("runnersVoidable", B), ("version", L), ("complete", B),
)
BOOK_PATHS = {f.name: f"$.{f.name}" for f in BOOK.fields}

PARTITION_COLUMNS = ("extracted_date", "run_time")


def with_partitions(schema: T.StructType) -> T.StructType:
    """A Bronze schema plus its two partition columns."""
    return T.StructType(
        schema.fields
        + [T.StructField("extracted_date", DATE, True), T.StructField("run_time", S, True)]
    )
