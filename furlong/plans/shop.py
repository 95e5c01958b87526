"""Shop models: staging and marts.

Every model is a function of DataFrames. Staging models are cheap projections and are meant
to be views; marts are meant to be tables (see ``furlong.sources.tables``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.functions.dates import to_day
from furlong.functions.keys import surrogate_key
from furlong.functions.money import cents_to_dollars
from furlong.functions.predicates import DRINK_TYPE, FOOD_TYPE, customer_type, flag_to_int, is_type
from furlong.operators.joins import lookup_pair
from furlong.operators.ranking import number_rows

# ---------------------------------------------------------------- staging


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))


def stg_locations(raw_stores: DataFrame) -> DataFrame:
    return raw_stores.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        "tax_rate",
        to_day(F.col("opened_at")).alias("opened_date"),
    )


def stg_order_items(raw_items: DataFrame) -> DataFrame:
    return raw_items.select(
        F.col("id").alias("order_item_id"), "order_id", F.col("sku").alias("product_id")
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    money = ("subtotal", "tax_paid", "order_total")
    return raw_orders.select(
        F.col("id").alias("order_id"),
        F.col("store_id").alias("location_id"),
        F.col("customer").alias("customer_id"),
        *[F.col(c).alias(f"{c}_cents") for c in money],
        *[cents_to_dollars(c).alias(c) for c in money],
        to_day(F.col("ordered_at")).alias("order_date"),
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    kind = F.col("type")
    return raw_products.select(
        F.col("sku").alias("product_id"),
        F.col("name").alias("product_name"),
        kind.alias("product_type"),
        F.col("description").alias("product_description"),
        cents_to_dollars("price").alias("product_price"),
        is_type(kind, FOOD_TYPE).alias("is_food_item"),
        is_type(kind, DRINK_TYPE).alias("is_drink_item"),
    )


def stg_supplies(raw_supplies: DataFrame) -> DataFrame:
    return raw_supplies.select(
        surrogate_key("id", "sku").alias("supply_uuid"),
        F.col("id").alias("supply_id"),
        F.col("sku").alias("product_id"),
        F.col("name").alias("supply_name"),
        cents_to_dollars("cost").alias("supply_cost"),
        F.col("perishable").alias("is_perishable_supply"),
    )


# ---------------------------------------------------------------- marts


def locations(staged: DataFrame) -> DataFrame:
    return staged


def products(staged: DataFrame) -> DataFrame:
    return staged


def supplies(staged: DataFrame) -> DataFrame:
    return staged


def supply_costs(stg_supplies: DataFrame) -> DataFrame:
    """Cost of all supplies of a product."""
    return stg_supplies.groupBy("product_id").agg(F.sum("supply_cost").alias("supply_cost"))


def priced_items(stg_order_items: DataFrame, stg_products: DataFrame, stg_supplies: DataFrame) -> DataFrame:
    """Items with product columns and supply cost. Products and costs reach the items in one join."""
    product_columns = ("product_name", "product_price", "is_food_item", "is_drink_item")
    product_facts = stg_products.where(F.col("product_id").isNotNull()).select("product_id", *product_columns)
    lookup = lookup_pair(product_facts, supply_costs(stg_supplies), "product_id")
    return stg_order_items.join(lookup, "product_id", "left").select(
        *[stg_order_items[c] for c in stg_order_items.columns], *product_columns, "supply_cost"
    )


def order_items(
    stg_order_items: DataFrame, stg_orders: DataFrame, stg_products: DataFrame, stg_supplies: DataFrame
) -> DataFrame:
    """Items with the order's date, product columns and supply cost. Items without a match stay."""
    items = priced_items(stg_order_items, stg_products, stg_supplies)
    dates = stg_orders.select("order_id", "order_date")
    return items.join(dates, "order_id", "left").select(
        *stg_order_items.columns, "order_date", "product_name", "product_price",
        "is_food_item", "is_drink_item", "supply_cost",
    )


def order_summary(order_items: DataFrame) -> DataFrame:
    """Costs and counts per order. The sums are combined in the map tasks."""
    return order_items.groupBy("order_id").agg(
        F.sum("supply_cost").alias("order_cost"),
        F.sum("product_price").alias("order_items_subtotal"),
        F.count("order_item_id").alias("count_order_items"),
        F.sum(flag_to_int(F.col("is_food_item"))).alias("count_food_items"),
        F.sum(flag_to_int(F.col("is_drink_item"))).alias("count_drink_items"),
    )


SUMMARY_COLUMNS = (
    "order_cost", "order_items_subtotal", "count_food_items", "count_drink_items", "count_order_items",
)


def _with_summary(stg_orders: DataFrame, summary: DataFrame) -> DataFrame:
    # The number depends on the order alone, so it is taken before the join: the narrow rows
    # are numbered. Ties on a day go by order_id.
    numbered = number_rows(stg_orders, "customer_id", "order_date", "order_id", "customer_order_number")
    return numbered.join(summary, "order_id", "left").select(
        *[numbered[c] for c in stg_orders.columns],
        *SUMMARY_COLUMNS,
        (F.col("count_food_items") > 0).alias("is_food_order"),
        (F.col("count_drink_items") > 0).alias("is_drink_order"),
        "customer_order_number",
    )


def orders(stg_orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders with their item summary, food and drink flags and the customer's order number.

    Orders without items keep NULL counts and NULL flags.
    """
    return _with_summary(stg_orders, order_summary(order_items))


def orders_from_staging(
    stg_orders: DataFrame, stg_order_items: DataFrame, stg_products: DataFrame, stg_supplies: DataFrame,
) -> DataFrame:
    """The orders mart straight from staging, for runs that do not store ``order_items``.

    The summary needs nothing from the orders side of ``order_items`` but its fan-out: an item
    counts once per order row with its id. So the large item-to-order join is replaced by the
    number of order rows per id, which multiplies the summary.
    """
    base = order_summary(priced_items(stg_order_items, stg_products, stg_supplies))
    copies = stg_orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("_copies"))
    scaled = base.join(copies, "order_id", "left").select(
        "order_id",
        *[
            (F.col(c) * F.coalesce("_copies", F.lit(1))).cast(base.schema[c].dataType).alias(c)
            for c in SUMMARY_COLUMNS
        ],
    )
    return _with_summary(stg_orders, scaled)


def order_history(orders: DataFrame) -> DataFrame:
    """Lifetime figures per customer."""
    distinct_orders = F.count_distinct("order_id")
    return orders.groupBy("customer_id").agg(
        distinct_orders.alias("count_lifetime_orders"),
        (distinct_orders > 1).alias("is_repeat_buyer"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum("subtotal").alias("lifetime_spend_pretax"),
        F.sum("tax_paid").alias("lifetime_tax_paid"),
        F.sum("order_total").alias("lifetime_spend"),
    )


def customers(stg_customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with lifetime figures and type. Those without orders stay, as ``new``.

    ``orders`` may be the mart or ``stg_orders``: the mart holds the same rows, and the columns
    read here are the same in both.
    """
    return stg_customers.join(order_history(orders), "customer_id", "left").select(
        *[stg_customers[c] for c in stg_customers.columns],
        "count_lifetime_orders", "first_order_date", "last_order_date",
        "lifetime_spend_pretax", "lifetime_tax_paid", "lifetime_spend",
        customer_type(F.col("is_repeat_buyer")).alias("customer_type"),
    )
