"""Catalogue and book: landed responses to Bronze rows, and the Silver steps after them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions.dates import starts_within_day
from furlong.functions.gate import accepted, gate, is_object, passes
from furlong.functions.predicates import has_text, wanted_market
from furlong.operators.keyed import latest_snapshot, top_per_key
from furlong.schemas import BOOK, BOOK_PATHS, CATALOGUE, CATALOGUE_PATHS
from furlong.sources.landing import records


def _of(path: str) -> Column:
    return F.try_variant_get("record", path, "string")


def wanted_records(items: DataFrame) -> DataFrame:
    """Records of the markets to keep. Unreadable ones and those that are no object stay, so that the gate reports them."""
    wanted = wanted_market(
        _of("$.eventType.id"), _of("$.event.countryCode"), _of("$.description.marketType")
    )
    return items.where(~F.expr(is_object("record")) | wanted)


def of_day(gated: DataFrame, day: Column) -> DataFrame:
    """Gated markets without the accepted ones that start outside the local race day; rejects stay.

    After the gate, so that a start time of a wrong type is a reject and does not vanish.
    """
    return gated.where(~passes() | F.coalesce(starts_within_day(F.col("market_start_time"), day), F.lit(False)))


def gated_catalogue(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Catalogue columns and gate result of each wanted market of the responses."""
    return gate(wanted_records(records(responses, keep)), CATALOGUE, CATALOGUE_PATHS, keep=keep)


def gated_book(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return gate(records(responses, keep), BOOK, BOOK_PATHS, keep=keep)


def catalogue(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid catalogue rows: one pass over the responses, no shuffle."""
    return accepted(gated_catalogue(responses, keep))


def market_ids(catalogue: DataFrame, *day: str) -> DataFrame:
    """Distinct ids of a catalogue, empty ones left out; per day, if the day's column is named."""
    return catalogue.where(has_text(F.col("market_id"))).select("market_id", *day).distinct()


def books_of(books: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Book rows of the catalogue's markets. Books that carry their ``extracted_date`` belong to the catalogue of that day."""
    day = [c for c in ("extracted_date",) if c in books.columns]
    ids = market_ids(catalogue, *day)
    matches = [books["marketId"] == ids["market_id"], *(books[c] == ids[c] for c in day)]
    return books.join(ids, matches, "left_semi")


def book(responses: DataFrame, catalogue: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid book rows of the markets that the catalogue holds."""
    return books_of(accepted(gated_book(responses, keep)), catalogue)


def first_to_start(catalogue: DataFrame, per: list[str], n: int) -> DataFrame:
    """The first ``n`` markets to start, per group (a race day, say); without groups, overall."""
    order = [F.asc("market_start_time"), F.asc("market_id")]
    if not per:
        return catalogue.orderBy(*order).limit(n)
    return top_per_key(catalogue, per, order, n)


# Runner keys of the two feeds, as the projections ask for them.
CATALOGUE_RUNNER = {"selection_id": ("selectionId", "bigint"), "runner_name": ("runnerName", "string"), "sort_priority": ("sortPriority", "int")}
BOOK_RUNNER = {"selection_id": ("selectionId", "bigint"), "runner_status": ("status", "string"), "last_price_traded": ("lastPriceTraded", "double")}


def flat_runners(df: DataFrame, fields: dict[str, tuple[str, str]], keep: tuple[str, ...]) -> DataFrame:
    """One row per market and runner; a market without runners keeps one row with NULLs."""
    exploded = df.select(*keep, F.explode_outer("runners").alias("_runner"))
    return exploded.select(
        *keep,
        *[F.try_variant_get("_runner", f"$.{key}", dtype).alias(name) for name, (key, dtype) in fields.items()],
    )


def latest_book(books: DataFrame) -> DataFrame:
    """Newest snapshot per market; of equal ones the last to arrive."""
    return latest_snapshot(books, ["marketId"], ties=("arrival",))


def latest_catalogue(catalogue: DataFrame) -> DataFrame:
    return latest_snapshot(catalogue, ["market_id"], ties=("arrival",))


def catalogue_book(catalogue: DataFrame, books: DataFrame) -> DataFrame:
    """Newest catalogue row and newest book row of each market, with the book's runners.

    Both sides have one row per market before they meet, so no market can multiply.
    """
    c = latest_catalogue(catalogue).select(
        "market_id", "market_name", "market_start_time", "event_venue", "event_country"
    )
    b = latest_book(books).select(
        F.col("marketId").alias("market_id"), "status", F.col("totalMatched").alias("book_matched"), "runners"
    )
    joined = c.join(b, "market_id")
    return flat_runners(
        joined, BOOK_RUNNER,
        ("market_id", "market_name", "market_start_time", "event_venue", "event_country", "status", "book_matched"),
    )
