"""Shop models: the declared unit tests, fan-out rules and numbering of hot groups."""

from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from furlong.operators import checks
from furlong.operators.ranking import number_by_position, number_rows
from furlong.plans import shop, starter
from tests.conftest import rows

STG_ITEMS = "order_item_id string, order_id long, product_id long"
STG_PRODUCTS = ("product_id long, product_name string, product_type string, product_description string, "
                "product_price decimal(16,2), is_food_item boolean, is_drink_item boolean")
STG_SUPPLIES = "supply_uuid string, supply_id long, product_id long, supply_name string, supply_cost decimal(16,2), is_perishable_supply boolean"
STG_ORDERS = ("order_id long, location_id long, customer_id long, subtotal_cents long, tax_paid_cents long, order_total_cents long, "
              "subtotal decimal(16,2), tax_paid decimal(16,2), order_total decimal(16,2), order_date date")
ITEM_MART = ("order_item_id string, order_id long, product_id long, order_date date, product_name string, product_price decimal(16,2), "
             "is_food_item boolean, is_drink_item boolean, supply_cost decimal(26,2)")


def given(spark, ddl, *records):
    """Rows with the named values; the other columns are NULL."""
    names = [c.split()[0] for c in ddl.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ddl)


def order(i, customer=None, day=None, **more):
    return {"order_id": i, "customer_id": customer, "order_date": day, **more}


def test_opened_at_is_cut_to_its_day(spark):
    raw = spark.createDataFrame(
        [(1, "Vice City", 0.2, datetime(2016, 9, 1)), (2, "San Andreas", 0.1, datetime(2079, 10, 27, 23, 59, 59, 999900))],
        "id long, name string, tax_rate double, opened_at timestamp")
    assert rows(shop.stg_locations(raw)) == [
        (1, "Vice City", 0.2, date(2016, 9, 1)), (2, "San Andreas", 0.1, date(2079, 10, 27))]


def test_supply_costs_add_up(spark):
    d = Decimal
    got = shop.order_items(
        given(spark, STG_ITEMS, {"order_id": 1, "product_id": 1}, {"order_id": 2, "product_id": 2}, {"order_id": 2, "product_id": 2}),
        given(spark, STG_ORDERS, order(1), order(2)),
        given(spark, STG_PRODUCTS, {"product_id": 1}, {"product_id": 2}),
        given(spark, STG_SUPPLIES, {"product_id": 1, "supply_cost": d("4.50")}, {"product_id": 2, "supply_cost": d("3.50")},
              {"product_id": 2, "supply_cost": d("5.00")}))
    assert rows(got, "order_id", "product_id", "supply_cost") == [(1, 1, d("4.50")), (2, 2, d("8.50")), (2, 2, d("8.50"))]


def test_food_and_drink_flags(spark):
    items = given(spark, ITEM_MART,
                  {"order_id": 1, "order_item_id": "1", "is_drink_item": False, "is_food_item": True},
                  {"order_id": 1, "order_item_id": "2", "is_drink_item": True, "is_food_item": False},
                  {"order_id": 2, "order_item_id": "3", "is_drink_item": False, "is_food_item": True})
    got = shop.orders(given(spark, STG_ORDERS, order(1), order(2), order(3)), items)
    assert rows(got, "order_id", "count_food_items", "count_drink_items", "is_drink_order", "is_food_order") == [
        (1, 1, 1, True, True), (2, 1, 0, False, True), (3, None, None, None, None)]


def shop_case(spark):
    """Orders and products that repeat, items without order or product, supplies without product."""
    d = Decimal
    orders = given(spark, STG_ORDERS, order(1, 1, date(2026, 1, 2), subtotal=d("1.00")), order(1, 2, date(2026, 1, 1)), order(2, 1, date(2026, 1, 1)),
                   order(None, 1, date(2026, 1, 3)), order(3, None, None))
    items = given(spark, STG_ITEMS, *[{"order_item_id": f"i{i}", "order_id": o, "product_id": p}
                                     for i, (o, p) in enumerate([(1, 1), (1, 2), (2, 1), (9, 1), (2, None), (None, 2), (1, 8), (2, 7)])])
    products = given(spark, STG_PRODUCTS, {"product_id": 1, "product_price": d("2.00"), "is_food_item": True, "is_drink_item": False},
                     {"product_id": 2, "product_price": d("3.00"), "is_food_item": False, "is_drink_item": True},
                     {"product_id": 2, "product_price": d("3.50"), "is_food_item": False, "is_drink_item": True}, {"product_id": None})
    supplies = given(spark, STG_SUPPLIES, {"product_id": 1, "supply_cost": d("0.10")}, {"product_id": 7, "supply_cost": d("0.20")},
                     {"product_id": None, "supply_cost": d("9.00")})
    return orders, items, products, supplies


def test_joins_fan_out_and_keep_unmatched_items(spark):
    orders, items, products, supplies = shop_case(spark)
    got = shop.order_items(items, orders, products, supplies)
    for df, name in ((orders, "o"), (items, "i"), (products, "p"), (supplies, "s")):
        df.createOrReplaceTempView(name)
    want = spark.sql("""SELECT i.*, o.order_date, p.product_name, p.product_price, p.is_food_item, p.is_drink_item, c.supply_cost
        FROM i LEFT JOIN o ON i.order_id = o.order_id LEFT JOIN p ON i.product_id = p.product_id
        LEFT JOIN (SELECT product_id, SUM(supply_cost) AS supply_cost FROM s GROUP BY 1) c ON i.product_id = c.product_id""")
    assert rows(got) == rows(want) and got.columns == want.columns


def test_orders_from_staging_equals_orders_from_items(spark):
    orders, items, products, supplies = shop_case(spark)
    via_items = shop.orders(orders, shop.order_items(items, orders, products, supplies))
    direct = shop.orders_from_staging(orders, items, products, supplies)
    assert direct.dtypes == via_items.dtypes
    assert rows(direct.drop("customer_order_number")) == rows(via_items.drop("customer_order_number"))


def test_customers_without_orders_are_new(spark):
    customers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "customer_id long, customer_name string")
    orders = given(spark, STG_ORDERS, order(1, 1, date(2026, 1, 1)), order(2, 1, date(2026, 1, 5)), order(3, 2, date(2026, 1, 2)))
    got = shop.customers(customers, orders)
    assert rows(got, "customer_id", "count_lifetime_orders", "customer_type", "last_order_date") == [
        (1, 2, "returning", date(2026, 1, 5)), (2, 1, "new", date(2026, 1, 2)), (3, None, "new", None)]


@pytest.mark.parametrize("block", [1 << 20, 64, 1, 1000])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_numbering_is_the_same_however_groups_are_cut(spark, kind, block):
    rng = random.Random(1)
    ids = rng.sample(range(10_000), 400)
    # One key holds a third of the rows, most of them on one day; some keys and days are NULL.
    data = [(i, None if n % 11 == 0 else (1 if n % 3 == 0 else n % 40), None if n % 17 == 0 else date(2026, 1, 1 + (n % 2) * (n % 5)))
            for n, i in enumerate(ids)]
    df = spark.createDataFrame(data, "order_id long, customer_id long, order_date date")
    df = df.withColumn("order_id", (F.col("order_id") if kind == "long" else F.concat(F.lit("o"), F.hex("order_id"))).cast(kind))
    df.createOrReplaceTempView("to_number")
    want = spark.sql("SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS n FROM to_number")
    got = number_rows(df, "customer_id", "order_date", "order_id", "n", block)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("block", [3, 64, 1 << 20])
def test_positions_number_globally(spark, block):
    positions = random.Random(2).sample(range(-50, 5000), 300)
    got = number_by_position(spark.createDataFrame([(p,) for p in positions], "p long"), "p", "i", block)
    assert rows(got) == sorted(((p, i) for i, p in enumerate(sorted(positions))), key=str)


def test_steps_of_the_bisection(spark):
    from furlong.operators import ranking

    steps = ranking._STEPS.format(at="at")
    below = ranking._BELOW.format(steps="steps", at="at", value="v")
    cuts = spark.range(200).selectExpr("filter(sequence(0, 400, 2), (x, n) -> n < id) AS at").selectExpr("at", f"{steps} AS steps")
    asked = cuts.crossJoin(spark.range(-1, 402).selectExpr("id AS v"))
    wrong = asked.selectExpr("size(at) AS n", "size(steps) AS s", f"{below} AS got", "size(filter(at, c -> c < v)) AS want")
    assert wrong.where("got <> want OR (n > 0 AND s <> floor(log2(n)) + 1)").isEmpty()


def test_starter_models(spark):
    ids = starter.literal_ids(spark)
    assert rows(ids) == [(1,), (None,)]
    assert rows(starter.first_id(ids)) == [(1,)] and rows(starter.known_ids(ids)) == [(1,)]
    assert checks.not_null(ids, "id").count() == 1 and checks.unique(ids, "id").count() == 0


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None), (None, "a"), (2, "z")], "k int, v string")
    assert checks.not_null(df, "k").count() == 2
    assert rows(checks.unique(df, "k")) == [(1, 2)]
    assert rows(checks.accepted_values(df, "v", ["a", "b"])) == [("z", 1)]
    assert rows(checks.relationships(df, "k", df.where("k = 1"), "k")) == [(2,)]
    assert checks.expression_is_true(df, "k = 1").count() == 1
    assert rows(checks.failures(checks.not_null(df, "k"), "c")) == [("c", 2)]
    with pytest.raises(Exception):
        checks.expression_is_true(df, "no_such_column = 1").count()


def test_a_report_counts_like_the_single_checks_in_one_pass(spark, tmp_path):
    data = [(1, 1, "a", 5), (2, 1, "b", None), (None, None, None, 7), (4, 9, "a", -1), (5, 2, "z", 0), (6, 9, "y", 3), (7, 9, "z", -2)]
    path = str(tmp_path / "t")
    spark.createDataFrame(data, "id long, k int, v string, n int").write.parquet(path)
    df, parent = spark.read.parquet(path), spark.createDataFrame([(1,), (2,), (None,), (2,)], "p long")
    rules = [
        checks.Rule("id", "not_null", "id"), checks.Rule("one", "unique", "k"), checks.Rule("fine", "unique", "id"), checks.Rule("v", "accepted_values", "v", values=("a", "b")),
        checks.Rule("n", "expression_is_true", expression="n >= 0"), checks.Rule("parent", "relationships", "k", parent=parent, field="p"), checks.Rule("self", "relationships", "k", parent=df, field="k")]
    single = {
        "id": checks.not_null(df, "id"), "one": checks.unique(df, "k"), "fine": checks.unique(df, "id"), "v": checks.accepted_values(df, "v", ["a", "b"]),
        "n": checks.expression_is_true(df, "n >= 0"), "parent": checks.relationships(df, "k", parent, "p"), "self": checks.relationships(df, "k", df, "k")}
    got = {r.check_name: tuple(r)[1:] for r in checks.report(df, rules, "id").collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v.count() for k, v in single.items()}
    assert got == {"id": (1, None, None), "one": (2, "1", "9"), "fine": (0, None, None), "v": (2, "y", "z"), "n": (2, "4", "7"), "parent": (3, "9", "9"), "self": (0, None, None)}
    plan = checks.report(df, rules[:5], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert {r.failures for r in checks.report(df.limit(0), rules, "id").collect()} == {0}


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_report_joins_no_pairs(spark):
    df = spark.range(20).selectExpr("id", "id % 7 AS k")
    rules = [checks.Rule("one", "unique", "id"), checks.Rule("parent", "relationships", "k", parent=spark.range(5), field="id"),
             checks.Rule("other", "relationships", "id", parent=spark.range(3, 18), field="id")]
    got = checks.report(df, rules, "id")
    assert optimized(got.select("check_name", "failures")).count("Join ") == 1  # the names' only
    assert rows(got) == [("one", 0, None, None), ("other", 5, "0", "2"), ("parent", 5, "5", "6")]


def test_a_report_keeps_every_text_apart(spark):
    texts = ["", "0", "00", "000", "a", "0a", "-", "0-", "A", "0A", "a\n", "0\n", "-\n", "\n", " ", "a-", "ab", "..", "::", "1-2/3", "1.2:3", "1_2 3", "é", "0é", "0" * 33, "f" * 32, "F" * 32, "12-34-5", "12a34a5"]
    df = spark.createDataFrame([(t,) for t in texts for _ in range(2)], "v string")
    assert rows(checks.report(df, [checks.Rule("v", "unique", "v")], "v"), "failures") == [(len(texts),)]
    for t in texts:
        one = checks.report(df.where(F.col("v") == t), [checks.Rule("v", "unique", "v"), checks.Rule("r", "expression_is_true", expression="v IS NULL")], "v")
        assert rows(one) == [("r", 2, t, t), ("v", 1, t, t)]


def test_rows_are_shuffled_once_to_number_them(spark):
    planned = lambda df: df._jdf.queryExecution().executedPlan().toString()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).selectExpr("id AS order_id", "id % 3 AS customer_id", "date'2026-01-01' + CAST(id % 2 AS int) AS order_date")
        assert "SortMergeJoin" not in planned(number_rows(df, "customer_id", "order_date", "order_id", "n", 10))
        # Rows that lie by key are dealt anew, by key and block: a hot key is not one task's.
        by_key = planned(number_rows(df.repartition("customer_id"), "customer_id", "order_date", "order_id", "n", 10))
        assert "ENSURE_REQUIREMENTS" in by_key[by_key.index("row_number()"):by_key.index("REPARTITION_BY_COL")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
