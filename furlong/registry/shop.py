"""Shop queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from furlong.functions.keys import surrogate_key
from furlong.functions.money import cents_to_dollars
from furlong.functions.predicates import CUSTOMER_TYPES, customer_type, flag_to_int, is_type
from furlong.operators import checks, keyed, ranking
from furlong.plans import shop, starter
from furlong.registry.core import Inputs, registry
from furlong.schemas import SHOP_RAW
from furlong.sources import tables

model, add = registry.model, registry.add


# ---------------------------------------------------------------- Spark side
def staged(t: Inputs, name: str):
    """A staging model over its raw proxy."""
    raw = {
        "stg_customers": "raw_customers", "stg_locations": "raw_stores", "stg_order_items": "raw_items",
        "stg_orders": "raw_orders", "stg_products": "raw_products", "stg_supplies": "raw_supplies",
    }[name]
    return getattr(shop, name)(t(raw))


def order_items(t: Inputs):
    return shop.order_items(*[staged(t, s) for s in ("stg_order_items", "stg_orders", "stg_products", "stg_supplies")])


def orders(t: Inputs):
    return shop.orders_from_staging(
        *[staged(t, s) for s in ("stg_orders", "stg_order_items", "stg_products", "stg_supplies")]
    )


def customers(t: Inputs):
    return shop.customers(staged(t, "stg_customers"), staged(t, "stg_orders"))


# ---------------------------------------------------------------- comparison SQL
model("m_customers", "SELECT id AS customer_id, name AS customer_name FROM raw_customers")
model("m_locations", "SELECT id AS location_id, name AS location_name, tax_rate, CAST(opened_at AS DATE) AS opened_date FROM raw_stores")
model("m_items", "SELECT id AS order_item_id, order_id, sku AS product_id FROM raw_items")
model("m_orders", """SELECT id AS order_id, store_id AS location_id, customer AS customer_id,
    subtotal AS subtotal_cents, tax_paid AS tax_paid_cents, order_total AS order_total_cents,
    CAST(subtotal / 100 AS DECIMAL(16,2)) AS subtotal, CAST(tax_paid / 100 AS DECIMAL(16,2)) AS tax_paid,
    CAST(order_total / 100 AS DECIMAL(16,2)) AS order_total, CAST(ordered_at AS DATE) AS order_date
    FROM raw_orders""")
model("m_products", """SELECT sku AS product_id, name AS product_name, type AS product_type,
    description AS product_description, CAST(price / 100 AS DECIMAL(16,2)) AS product_price,
    COALESCE(type = 'jaffle', FALSE) AS is_food_item, COALESCE(type = 'beverage', FALSE) AS is_drink_item
    FROM raw_products""")
model("m_supplies", """SELECT md5(COALESCE(CAST(id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
      COALESCE(CAST(sku AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS supply_uuid,
    id AS supply_id, sku AS product_id, name AS supply_name, CAST(cost / 100 AS DECIMAL(16,2)) AS supply_cost,
    perishable AS is_perishable_supply FROM raw_supplies""")
model("m_costs", "SELECT product_id, SUM(supply_cost) AS supply_cost FROM m_supplies GROUP BY product_id")
model("m_order_items", """SELECT i.order_item_id, i.order_id, i.product_id, o.order_date, p.product_name,
    p.product_price, p.is_food_item, p.is_drink_item, c.supply_cost
    FROM m_items i LEFT JOIN m_orders o ON i.order_id = o.order_id
    LEFT JOIN m_products p ON i.product_id = p.product_id LEFT JOIN m_costs c ON i.product_id = c.product_id""")
model("m_summary", """SELECT order_id, SUM(supply_cost) AS order_cost, SUM(product_price) AS order_items_subtotal,
    COUNT(order_item_id) AS count_order_items,
    SUM(CASE WHEN is_food_item THEN 1 ELSE 0 END) AS count_food_items,
    SUM(CASE WHEN is_drink_item THEN 1 ELSE 0 END) AS count_drink_items FROM m_order_items GROUP BY order_id""")
model("m_orders_mart", """SELECT o.*, s.order_cost, s.order_items_subtotal, s.count_food_items, s.count_drink_items,
    s.count_order_items, s.count_food_items > 0 AS is_food_order, s.count_drink_items > 0 AS is_drink_order,
    ROW_NUMBER() OVER (PARTITION BY o.customer_id ORDER BY o.order_date, o.order_id) AS customer_order_number
    FROM m_orders o LEFT JOIN m_summary s ON o.order_id = s.order_id""")
model("m_history", """SELECT customer_id, COUNT(DISTINCT order_id) AS count_lifetime_orders,
    COUNT(DISTINCT order_id) > 1 AS is_repeat_buyer, MIN(order_date) AS first_order_date,
    MAX(order_date) AS last_order_date, SUM(subtotal) AS lifetime_spend_pretax,
    SUM(tax_paid) AS lifetime_tax_paid, SUM(order_total) AS lifetime_spend FROM m_orders_mart GROUP BY customer_id""")
model("m_customers_mart", """SELECT c.*, h.count_lifetime_orders, h.first_order_date, h.last_order_date,
    h.lifetime_spend_pretax, h.lifetime_tax_paid, h.lifetime_spend,
    CASE WHEN h.is_repeat_buyer THEN 'returning' ELSE 'new' END AS customer_type
    FROM m_customers c LEFT JOIN m_history h ON c.customer_id = h.customer_id""")

CUSTOMERS = "customer_id:l customer_name"
LOCATIONS = "location_id:l location_name tax_rate:f opened_date:d"
ITEMS = "order_item_id order_id:l product_id:l"
ORDERS = ("order_id:l location_id:l customer_id:l subtotal_cents:l tax_paid_cents:l order_total_cents:l "
          "subtotal:m tax_paid:m order_total:m order_date:d")
PRODUCTS = "product_id:l product_name product_type product_description product_price:m is_food_item:b is_drink_item:b"
SUPPLIES = "supply_uuid supply_id:l product_id:l supply_name supply_cost:m is_perishable_supply:b"
ORDER_ITEMS = f"{ITEMS} order_date:d product_name product_price:m is_food_item:b is_drink_item:b supply_cost:m"
SUMMARY = "order_cost:m order_items_subtotal:m count_food_items:l count_drink_items:l count_order_items:l"
ORDERS_MART = f"{ORDERS} {SUMMARY} is_food_order:b is_drink_order:b customer_order_number:l"
LIFETIME = ("count_lifetime_orders:l first_order_date:d last_order_date:d lifetime_spend_pretax:m "
            "lifetime_tax_paid:m lifetime_spend:m")
CUSTOMERS_MART = f"{CUSTOMERS} {LIFETIME} customer_type"

# ---------------------------------------------------------------- models
STAGING = {
    "stg_customers": (CUSTOMERS, "m_customers", "p1_customers"),
    "stg_locations": (LOCATIONS, "m_locations", "p2_stores"),
    "stg_order_items": (ITEMS, "m_items", "p3_order_items"),
    "stg_orders": (ORDERS, "m_orders", "p4_orders"),
    "stg_products": (PRODUCTS, "m_products", "p5_products"),
    "stg_supplies": (SUPPLIES, "m_supplies", "p6_supplies"),
}
for _name, (_columns, _model, _id) in STAGING.items():
    for _key in (_name, _id):
        add(_key, _columns, lambda t, n=_name: staged(t, n), f"SELECT * FROM {_model}")

for _name, (_staging, _columns, _model) in {
    "locations": ("stg_locations", LOCATIONS, "m_locations"),
    "products": ("stg_products", PRODUCTS, "m_products"),
    "supplies": ("stg_supplies", SUPPLIES, "m_supplies"),
}.items():
    add(_name, _columns, lambda t, n=_name, s=_staging: getattr(shop, n)(staged(t, s)), f"SELECT * FROM {_model}")
add("p7_pass_through", LOCATIONS, lambda t: shop.locations(staged(t, "stg_locations")), "SELECT * FROM m_locations")

add("order_items_mart", ORDER_ITEMS, order_items, "SELECT * FROM m_order_items")
add("orders_mart", ORDERS_MART, orders, "SELECT * FROM m_orders_mart")
add("orders_mart_from_items", ORDERS_MART,
    lambda t: shop.orders(staged(t, "stg_orders"), order_items(t)), "SELECT * FROM m_orders_mart")
add("customers_mart", CUSTOMERS_MART, customers, "SELECT * FROM m_customers_mart")
add("customers_mart_from_orders", CUSTOMERS_MART,
    lambda t: shop.customers(staged(t, "stg_customers"), orders(t)), "SELECT * FROM m_customers_mart")

# ---------------------------------------------------------------- projections, joins
add("p8_star_plus", f"{ORDERS} is_large:b",
    lambda t: staged(t, "stg_orders").select("*", (F.col("subtotal") > 1000).alias("is_large")),
    "SELECT *, subtotal > 1000 AS is_large FROM m_orders")
add("j2_customer_history", f"customer_id:l {LIFETIME} is_repeat_buyer:b",
    lambda t: staged(t, "stg_customers").join(shop.order_history(staged(t, "stg_orders")), "customer_id", "left"),
    "SELECT c.customer_id, h.* EXCLUDE (customer_id) FROM m_customers c LEFT JOIN m_history h ON c.customer_id = h.customer_id")
add("j3_item_order_date", f"{ITEMS} order_date:d",
    lambda t: staged(t, "stg_order_items").join(staged(t, "stg_orders").select("order_id", "order_date"), "order_id", "left"),
    "SELECT i.*, o.order_date FROM m_items i LEFT JOIN m_orders o ON i.order_id = o.order_id")
add("j4_item_product", f"{ITEMS} product_name product_price:m",
    lambda t: staged(t, "stg_order_items").join(staged(t, "stg_products"), "product_id", "left"),
    "SELECT i.*, p.product_name, p.product_price FROM m_items i LEFT JOIN m_products p ON i.product_id = p.product_id")
add("j5_item_supply_cost", f"{ITEMS} supply_cost:m",
    lambda t: staged(t, "stg_order_items").join(shop.supply_costs(staged(t, "stg_supplies")), "product_id", "left"),
    "SELECT i.*, c.supply_cost FROM m_items i LEFT JOIN m_costs c ON i.product_id = c.product_id")
add("j6_order_summary", f"order_id:l customer_id:l {SUMMARY}",
    lambda t: staged(t, "stg_orders").join(
        shop.order_summary(shop.priced_items(*[staged(t, s) for s in ("stg_order_items", "stg_products", "stg_supplies")])),
        "order_id", "left"),
    "SELECT o.order_id, o.customer_id, s.* EXCLUDE (order_id) FROM m_orders o LEFT JOIN m_summary s ON o.order_id = s.order_id")

# ---------------------------------------------------------------- aggregates
add("a1_group_by_one_key", "customer_id:l n_orders:l",
    lambda t: staged(t, "stg_orders").groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders")),
    "SELECT customer_id, COUNT(*) AS n_orders FROM m_orders GROUP BY 1")
add("a2_distinct_orders", "customer_id:l count_lifetime_orders:l",
    lambda t: shop.order_history(staged(t, "stg_orders")),
    "SELECT customer_id, COUNT(DISTINCT order_id) AS count_lifetime_orders FROM m_orders GROUP BY 1")
add("a3_repeat_buyer", "customer_id:l is_repeat_buyer:b",
    lambda t: shop.order_history(staged(t, "stg_orders")),
    "SELECT customer_id, COUNT(DISTINCT order_id) > 1 AS is_repeat_buyer FROM m_orders GROUP BY 1")
add("a4_first_last_date", "customer_id:l first_order_date:d last_order_date:d",
    lambda t: shop.order_history(staged(t, "stg_orders")),
    "SELECT customer_id, MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date FROM m_orders GROUP BY 1")
add("a5_money_sums", "customer_id:l lifetime_spend_pretax:m lifetime_tax_paid:m lifetime_spend:m",
    lambda t: shop.order_history(staged(t, "stg_orders")),
    """SELECT customer_id, SUM(subtotal) AS lifetime_spend_pretax, SUM(tax_paid) AS lifetime_tax_paid,
       SUM(order_total) AS lifetime_spend FROM m_orders GROUP BY 1""")
add("a6_supply_cost", "product_id:l supply_cost:m",
    lambda t: shop.supply_costs(staged(t, "stg_supplies")), "SELECT * FROM m_costs")
for _name, _columns in {
    "a7_order_sums": "order_id:l order_cost:m order_items_subtotal:m",
    "a8_count_items": "order_id:l count_order_items:l",
    "a9_conditional_counts": "order_id:l count_food_items:l count_drink_items:l",
}.items():
    add(_name, _columns, lambda t: shop.order_summary(order_items(t)), "SELECT * FROM m_summary")
add("a11_any_row", "has_rows:b", lambda t: keyed.any_row(t("raw_items").where("order_id < 0")),
    "SELECT EXISTS (SELECT 1 FROM raw_items WHERE order_id < 0) AS has_rows")
add("f12_conditional_flag", "product_id:l food:l",
    lambda t: staged(t, "stg_products").select("product_id", flag_to_int(F.col("product_type") == "jaffle").alias("food")),
    "SELECT product_id, CASE WHEN product_type = 'jaffle' THEN 1 ELSE 0 END AS food FROM m_products")

# ---------------------------------------------------------------- window
add("w1_customer_order_number", "order_id:l customer_id:l order_date:d customer_order_number:l",
    lambda t: ranking.number_rows(staged(t, "stg_orders"), "customer_id", "order_date", "order_id", "customer_order_number"),
    "SELECT order_id, customer_id, order_date, customer_order_number FROM m_orders_mart")
add("w1_customer_order_number_split", "order_id:l customer_id:l order_date:d customer_order_number:l",
    lambda t: ranking.number_rows(staged(t, "stg_orders"), "customer_id", "order_date", "order_id", "customer_order_number",
                                  block=100),
    "SELECT order_id, customer_id, order_date, customer_order_number FROM m_orders_mart")

# ---------------------------------------------------------------- scalar
# Odd cents, and amounts owed. Decimals are compared as text, with their scale; the variant that makes doubles as doubles.
_variants = ("default", "postgres", "bigquery", "fabric")
_CENTS = "(subtotal + id % 97) * CASE WHEN id % 5 = 0 THEN -1 ELSE 1 END"
add("x1_cents_to_dollars", "order_id:l cents:l " + " ".join(f"v_{v}" for v in _variants) + " v_spark:f",
    lambda t: t("raw_orders").select(F.col("id").alias("order_id"), F.expr(_CENTS).cast("bigint").alias("cents")).select(
        "*", *[cents_to_dollars("cents", v).alias(f"v_{v}") for v in (*_variants, "spark")]),
    f"""SELECT order_id, cents, CAST(cents / 100 AS DECIMAL(16,2)) AS v_default,
        CASE WHEN cents < 0 THEN '-' ELSE '' END || abs(cents) // 100 || '.' || lpad(CAST(abs(cents) % 100 AS VARCHAR), 2, '0') || '0000' AS v_postgres,
        ROUND(CAST(cents / 100 AS DECIMAL(38,9)), 2) AS v_bigquery, CAST(cents / 100 AS DECIMAL(16,2)) AS v_fabric,
        ROUND(cents / 100, 2) AS v_spark
        FROM (SELECT id AS order_id, CAST({_CENTS} AS BIGINT) AS cents FROM raw_orders)""")
add("x5_surrogate_key", "supply_uuid supply_id:l product_id:l",
    lambda t: t("raw_supplies").select(surrogate_key("id", "sku").alias("supply_uuid"), F.col("id").alias("supply_id"), F.col("sku").alias("product_id")),
    "SELECT supply_uuid, supply_id, product_id FROM m_supplies")
add("x7_timestamp_to_date", "location_id:l opened_date:d", lambda t: staged(t, "stg_locations"), "SELECT * FROM m_locations")
add("x9_null_safe_flag", "product_id:l is_other:b",
    lambda t: t("raw_products").select(F.col("sku").alias("product_id"), is_type(F.col("type"), "other").alias("is_other")),
    "SELECT sku AS product_id, COALESCE(type = 'other', FALSE) AS is_other FROM raw_products")
add("x10_count_positive", "order_id:l is_food_order:b is_drink_order:b", orders,
    "SELECT order_id, is_food_order, is_drink_order FROM m_orders_mart")
add("x11_customer_type", "customer_id:l customer_type",
    lambda t: shop.order_history(staged(t, "stg_orders")).select("customer_id", customer_type(F.col("is_repeat_buyer")).alias("customer_type")),
    "SELECT customer_id, CASE WHEN is_repeat_buyer THEN 'returning' ELSE 'new' END AS customer_type FROM m_history")

# ---------------------------------------------------------------- sources and sinks
def seed(t: Inputs, name: str, csv_columns: list[str]):
    """Store a raw proxy as CSV, then load it as a seed into a schema of its own."""
    folder = t.scratch()
    t(name).select(*csv_columns).write.option("header", True).csv(f"{folder}/csv")
    target = f"furlong_{folder[-12:]}"
    tables.load_seed(t.spark, f"{folder}/csv", name, target, f"{folder}/table")
    return target


def raw_columns(name: str) -> list[str]:
    return SHOP_RAW[name].names


add("s11_seed_load", "id:l name",
    lambda t: t.spark.table(f"{tables.raw_schema(seed(t, 'raw_customers', raw_columns('raw_customers')))}.raw_customers"),
    "SELECT id, name FROM raw_customers")
add("s12_source_table", "id:l store_id:l customer:l subtotal:l ordered_at:t",
    lambda t: tables.source(t.spark, seed(t, "raw_orders", raw_columns("raw_orders")), "raw_orders"),
    "SELECT id, store_id, customer, subtotal, ordered_at FROM raw_orders")
add("s13_source_freshness", "source_name max_loaded_at:t",
    lambda t: tables.freshness(t("raw_orders").withColumn("ordered_at", F.col("ordered_at").cast("timestamp")), "raw_orders").unionByName(
        tables.freshness(t("raw_stores"), "raw_stores")),
    """SELECT 'raw_orders' AS source_name, MAX(ordered_at) AS max_loaded_at FROM raw_orders
       UNION ALL SELECT 'raw_stores', MAX(opened_at) FROM raw_stores""")
add("s14_catalog_table", "id order_id:l sku:l",
    lambda t: tables.catalog_table(t.spark, "spark_catalog", tables.raw_schema(seed(t, "raw_items", raw_columns("raw_items"))), "raw_items"),
    "SELECT id, order_id, sku FROM raw_items")
add("s15_view", ITEMS, lambda t: tables.as_view(staged(t, "stg_order_items"), "furlong_stg_order_items"), "SELECT * FROM m_items")


def stored(t: Inputs, df, partition_by=(), bucket_by=None):
    folder = t.scratch()
    return tables.as_table(df, f"furlong_{folder[-12:]}", folder, partition_by, bucket_by)


add("s16_table", CUSTOMERS_MART, lambda t: stored(t, customers(t)), "SELECT * FROM m_customers_mart")
add("s16_table_bucketed", ORDERS, lambda t: stored(t, staged(t, "stg_orders"), bucket_by=(8, "order_id")), "SELECT * FROM m_orders")


# ---------------------------------------------------------------- starter models
def order_ids(t: Inputs):
    return starter.with_missing_id(t("orders").select(F.col("o_orderkey").alias("id")))


STARTER = "SELECT o_orderkey AS id FROM orders UNION ALL SELECT NULL"
add("starter_1", "id:l", order_ids, STARTER)
add("starter_2", "id:l", lambda t: starter.first_id(order_ids(t)), f"SELECT * FROM ({STARTER}) WHERE id = 1")
add("s17_literal_row", "id:l", order_ids, STARTER)
add("t3_union_all", "id:l",
    lambda t: t("raw_orders").select("id").unionByName(t("raw_items").select(F.col("order_id").alias("id"))),
    "SELECT id FROM raw_orders UNION ALL SELECT order_id FROM raw_items")
add("f2_equality", "id:l", lambda t: starter.first_id(order_ids(t)), f"SELECT * FROM ({STARTER}) WHERE id = 1")
add("f11_known_ids", "id:l", lambda t: starter.known_ids(order_ids(t)), "SELECT o_orderkey AS id FROM orders")

# ---------------------------------------------------------------- checks
add("c1_not_null", "product_id:l product_name", lambda t: checks.not_null(staged(t, "stg_products"), "product_type"),
    "SELECT product_id, product_name FROM m_products WHERE product_type IS NULL")
add("c2_unique", "unique_field:l n_records:l", lambda t: checks.unique(staged(t, "stg_order_items"), "order_id"),
    "SELECT order_id AS unique_field, COUNT(*) AS n_records FROM m_items GROUP BY 1 HAVING COUNT(*) > 1")
add("c3_relationships", "from_field:l",
    lambda t: checks.relationships(staged(t, "stg_order_items"), "order_id", staged(t, "stg_orders"), "order_id"),
    "SELECT order_id AS from_field FROM m_items WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM m_orders)")
add("c4_accepted_values", "value_field n_records:l",
    lambda t: checks.accepted_values(staged(t, "stg_products"), "product_type", ["jaffle", "beverage"]),
    "SELECT product_type AS value_field, COUNT(*) AS n_records FROM m_products WHERE product_type NOT IN ('jaffle', 'beverage') GROUP BY 1")
add("c5_expression_is_true", "order_id:l subtotal:m order_items_subtotal:m",
    lambda t: checks.expression_is_true(orders(t), "order_items_subtotal = subtotal"),
    "SELECT order_id, subtotal, order_items_subtotal FROM m_orders_mart WHERE NOT (order_items_subtotal = subtotal)")


def check(key: str, spark_check, sql: str) -> None:
    """A declared check: one row with its number of failing rows."""
    add(key, "check_name failures:l", lambda t: checks.failures(spark_check(t), key),
        f"SELECT '{key}' AS check_name, COUNT(*) AS failures FROM ({sql})")


_KEYS = {
    "stg_customers": ("m_customers", "customer_id"), "stg_locations": ("m_locations", "location_id"),
    "stg_order_items": ("m_items", "order_item_id"), "stg_orders": ("m_orders", "order_id"),
    "stg_products": ("m_products", "product_id"), "stg_supplies": ("m_supplies", "supply_uuid"),
}
for _name, (_model, _column) in _KEYS.items():
    check(f"dq_{_name}_not_null", lambda t, n=_name, c=_column: checks.not_null(staged(t, n), c),
          f"SELECT 1 FROM {_model} WHERE {_column} IS NULL")
    check(f"dq_{_name}_unique", lambda t, n=_name, c=_column: checks.unique(staged(t, n), c),
          f"SELECT {_column} FROM {_model} WHERE {_column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1")
for _name, (_frame, _model, _column) in {
    "order_items": (order_items, "m_order_items", "order_item_id"),
    "orders": (orders, "m_orders_mart", "order_id"),
    "customers": (customers, "m_customers_mart", "customer_id"),
}.items():
    check(f"dq_{_name}_not_null", lambda t, f=_frame, c=_column: checks.not_null(f(t), c),
          f"SELECT 1 FROM {_model} WHERE {_column} IS NULL")
    check(f"dq_{_name}_unique", lambda t, f=_frame, c=_column: checks.unique(f(t), c),
          f"SELECT {_column} FROM {_model} WHERE {_column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1")
check("dq_stg_order_items_order_not_null", lambda t: checks.not_null(staged(t, "stg_order_items"), "order_id"),
      "SELECT 1 FROM m_items WHERE order_id IS NULL")
check("dq_starter_not_null", lambda t: checks.not_null(order_ids(t), "id"), f"SELECT 1 FROM ({STARTER}) WHERE id IS NULL")
check("dq_starter_unique", lambda t: checks.unique(order_ids(t), "id"),
      f"SELECT id FROM ({STARTER}) WHERE id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1")
check("dq_order_items_relationships",
      lambda t: checks.relationships(order_items(t), "order_id", staged(t, "stg_orders"), "order_id"),
      "SELECT 1 FROM m_order_items WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM m_orders)")
check("dq_orders_relationships",
      lambda t: checks.relationships(orders(t), "customer_id", staged(t, "stg_customers"), "customer_id"),
      "SELECT 1 FROM m_orders_mart WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM m_customers)")
check("dq_customers_accepted_values",
      lambda t: checks.accepted_values(customers(t), "customer_type", list(CUSTOMER_TYPES)),
      "SELECT customer_type FROM m_customers_mart WHERE customer_type NOT IN ('new', 'returning') GROUP BY 1")
for _key, _frame, _model, _expression in (
    ("dq_customers_lifetime_spend", customers, "m_customers_mart", "lifetime_spend_pretax + lifetime_tax_paid = lifetime_spend"),
    ("dq_orders_items_subtotal", orders, "m_orders_mart", "order_items_subtotal = subtotal"),
    ("dq_orders_total", orders, "m_orders_mart", "order_total = subtotal + tax_paid"),
    ("dq_stg_orders_total", lambda t: staged(t, "stg_orders"), "m_orders", "order_total - tax_paid = subtotal"),
):
    check(_key, lambda t, f=_frame, e=_expression: checks.expression_is_true(f(t), e),
          f"SELECT 1 FROM {_model} WHERE NOT ({_expression})")


# ---------------------------------------------------------------- all checks of a table in one pass
def declared(t: Inputs) -> list:
    """Tables, the id of their rows, and the rules declared on them: the checks above, named alike."""
    rule = checks.Rule
    keyed = lambda name, column: [rule(f"dq_{name}_{kind}", kind, column) for kind in ("not_null", "unique")]
    of = {name: keyed(name, column) for name, (_, column) in _KEYS.items()}
    of["stg_order_items"].append(rule("dq_stg_order_items_order_not_null", "not_null", "order_id"))
    of["stg_orders"].append(rule("dq_stg_orders_total", "expression_is_true", expression="order_total - tax_paid = subtotal"))
    tables = [(staged(t, name), _KEYS[name][1], rules) for name, rules in of.items()]
    items = [*keyed("order_items", "order_item_id"), rule("dq_order_items_relationships", "relationships", "order_id", parent=staged(t, "stg_orders"), field="order_id")]
    mart = [*keyed("orders", "order_id"), rule("dq_orders_relationships", "relationships", "customer_id", parent=staged(t, "stg_customers"), field="customer_id"),
            rule("dq_orders_items_subtotal", "expression_is_true", expression="order_items_subtotal = subtotal"), rule("dq_orders_total", "expression_is_true", expression="order_total = subtotal + tax_paid")]
    people = [*keyed("customers", "customer_id"), rule("dq_customers_accepted_values", "accepted_values", "customer_type", values=CUSTOMER_TYPES),
              rule("dq_customers_lifetime_spend", "expression_is_true", expression="lifetime_spend_pretax + lifetime_tax_paid = lifetime_spend")]
    starter_rules = [rule("dq_starter_not_null", "not_null", "id"), rule("dq_starter_unique", "unique", "id")]
    return [*tables, (order_items(t), "order_item_id", items), (orders(t), "order_id", mart), (customers(t), "customer_id", people), (order_ids(t), "id", starter_rules)]


def all_checks(t: Inputs):
    return reduce(lambda a, b: a.unionByName(b), (checks.report(df, rules, row_id) for df, row_id, rules in declared(t)))


add("dq_report", "check_name failures:l", all_checks,
    " UNION ALL ".join(f"({q.sql})" for name, q in registry.queries.items() if name.startswith("dq_")))
