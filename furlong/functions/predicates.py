"""Small predicates and flags shared by the models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Product types and customer types of the shop models.
FOOD_TYPE = "jaffle"
DRINK_TYPE = "beverage"
CUSTOMER_TYPES = ("new", "returning")

# The market filter of the catalogue.
MARKET_EVENT_TYPES = ("7",)
MARKET_COUNTRIES = ("AU",)
MARKET_TYPES = ("WIN",)


def is_type(product_type: Column, wanted: str) -> Column:
    """Equality that is false, not NULL, for a missing type."""
    return F.coalesce(product_type == F.lit(wanted), F.lit(False))


def flag_to_int(flag: Column) -> Column:
    """1 for true, 0 for false and for NULL."""
    return F.when(flag, 1).otherwise(0)


def customer_type(is_repeat_buyer: Column) -> Column:
    """``returning`` for repeat buyers, else ``new``; customers without orders are ``new``."""
    return F.when(is_repeat_buyer, CUSTOMER_TYPES[1]).otherwise(CUSTOMER_TYPES[0])


def not_scratched(scratched: Column) -> Column:
    """scratched = false; an unknown flag does not pass."""
    return scratched == F.lit(False)


def has_text(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def wanted_market(event_type_id: Column, country: Column, market_type: Column) -> Column:
    return (
        event_type_id.isin(*MARKET_EVENT_TYPES)
        & country.isin(*MARKET_COUNTRIES)
        & market_type.isin(*MARKET_TYPES)
    )
