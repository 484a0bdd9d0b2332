from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.operators import dimensions, facts, marts
from tillflow.operators.ranking import rank_descending

FACT = (
    "order_id string, date_key string, order_date date, unit_key long, order_type string, order_status string, "
    "order_value decimal(10,2), delivery_fee decimal(10,2), total_items long"
)
ITEM_FACT = (
    "item_id string, order_id string, order_date date, unit_key long, product_key long, quantity long, "
    "unit_price decimal(10,2), total_item_value decimal(20,2)"
)


def test_default_date_dimension(spark):
    found = dimensions.dim_date(spark)
    assert found.count() == 1095
    assert len(found.columns) == 20
    assert rows(found.agg(F.min("date_key"), F.max("date_key"))) == [("20250101", "20271231")]
    assert found.filter(F.col("is_weekend") == F.col("is_weekday")).count() == 0


@pytest.mark.parametrize(
    ("day", "week", "iso", "weekday", "quarter"),
    [
        (date(2025, 1, 1), 0, 1, 4, "2025-Q1"),
        (date(2025, 1, 5), 1, 1, 1, "2025-Q1"),
        (date(2027, 1, 1), 0, 53, 6, "2027-Q1"),
        (date(2026, 12, 31), 52, 53, 5, "2026-Q4"),
    ],
)
def test_week_numbers(spark, day, week, iso, weekday, quarter):
    found = dimensions.dim_date(spark, day, day)
    assert rows(found, "week_of_year", "iso_week", "day_of_week_num", "year_quarter") == [(week, iso, weekday, quarter)]


def test_month_columns(spark):
    found = dimensions.dim_date(spark, date(2028, 2, 29), date(2028, 2, 29))
    columns = ("day_in_month", "last_day_of_month", "first_day_of_month", "month_name", "day_of_week_abbrev", "day_of_year")
    assert rows(found, *columns) == [(29, date(2028, 2, 29), date(2028, 2, 1), "February", "Tue", 60)]


def test_versions_are_open(spark):
    units = spark.createDataFrame([(1, "U", 2, "S", 3, "C")], "unit_id long, unit_name string, state_id long, state_name string, country_id long, country_name string")
    found = dimensions.dim_unit(units, datetime(2026, 1, 1))
    shown = found.select("unit_key", "is_current", F.col("_valid_to").cast("string"), F.col("_valid_from").cast("string"))
    assert rows(shown) == [(1, True, "9999-12-31 23:59:59", "2026-01-01 00:00:00")]


def test_geography_drops_states_without_country(spark):
    states = spark.createDataFrame([(1, 5, "A"), (2, 6, "B")], "state_id long, country_id long, state_name string")
    countries = spark.createDataFrame([(5, "X")], "country_id long, country_name string")
    assert rows(dimensions.dim_geography(states, countries)) == [(1, 1, "A", 5, "X")]


def test_order_fact_counts_items_and_zero_for_none(spark):
    orders = spark.createDataFrame(
        [("O1", 1), ("O2", 1)],
        "order_id string, unit_id long",
    ).selectExpr(
        "*", "date'2026-01-15' order_date", "'ONLINE' order_type", "'Finalizado' order_status", "1.00BD order_value",
        "0.00BD delivery_fee", "1.00BD items_subtotal", "null delivery_address", "date'2026-01-16' _ingest_date",
    )
    items = spark.createDataFrame([("O1", 1, 2), ("O1", 1, 3), ("O1", 2, 1)], "order_id string, product_id long, quantity long")
    found = facts.fact_sales(orders, items).orderBy("order_id")
    assert rows(found, "order_id", "date_key", "total_items", "distinct_products", "total_quantity") == [
        ("O1", "20260115", 3, 2, 6),
        ("O2", "20260115", 0, 0, 0),
    ]


def random_sales(spark, repeat: bool):
    pick = random.Random(5)
    out = []
    for i in range(400):
        day = date(2025, 1, 1 + pick.randrange(5))
        row = (
            f"O{i}", day.strftime("%Y%m%d"), day, pick.choice([1, 1, 1, 2, 3]), pick.choice(["ONLINE", "PHYSICAL", "UNKNOWN"]),
            pick.choice(["Finalizado", "Cancelado", "Pendente"]), Decimal(pick.randrange(100, 9999)) / 100,
            pick.choice([None, Decimal(pick.randrange(2500)) / 100]), pick.randrange(6),
        )
        out += [row] * (2 if repeat and i % 7 == 0 else 1)
    return spark.createDataFrame(out, FACT)


def literal_metrics(fact, key):
    """The aggregation as it reads: distinct counts of conditional order ids."""

    def orders(column, value):
        return F.count_distinct(F.when(F.col(column) == value, F.col("order_id")))

    return fact.groupBy(key).agg(
        F.count_distinct("order_id").alias("total_orders"),
        orders("order_type", "ONLINE").alias("online_orders"),
        orders("order_type", "PHYSICAL").alias("physical_orders"),
        orders("order_status", "Finalizado").alias("completed_orders"),
        orders("order_status", "Cancelado").alias("canceled_orders"),
        F.sum("order_value").cast("decimal(20,2)").alias("total_revenue"),
        F.sum("total_items").alias("total_items_sold"),
    )


@pytest.mark.parametrize("repeat", [False, True])
def test_daily_mart_equals_the_literal_form(spark, repeat):
    fact = random_sales(spark, repeat)
    days = dimensions.dim_date(spark, date(2025, 1, 1), date(2025, 1, 31))
    found = marts.agg_daily_sales(days, fact, orders_unique=not repeat)
    literal = literal_metrics(fact, "date_key")
    assert sorted(rows(found, *literal.columns)) == sorted(rows(literal))
    units = fact.groupBy("date_key").agg(F.count_distinct("unit_key"))
    assert sorted(rows(found, "date_key", "active_units")) == sorted(rows(units))
    if not repeat:
        assert sorted(rows(found)) == sorted(rows(marts.agg_daily_sales(days, fact)))
    newest = [r.order_date for r in found.collect()]
    assert newest == sorted(newest, reverse=True)


@pytest.mark.parametrize("repeat", [False, True])
def test_unit_mart_equals_the_literal_form(spark, repeat):
    fact = random_sales(spark, repeat)
    units = spark.createDataFrame(
        [(k, k, f"U{k}", "S", "C") for k in (1, 2, 3, 4)],
        "unit_key long, unit_id long, unit_name string, state_name string, country_name string",
    )
    found = marts.agg_unit_performance(units, fact, orders_unique=not repeat)
    literal = literal_metrics(fact, "unit_key")
    assert sorted(rows(found, *literal.columns)) == sorted(rows(literal))
    ranks = literal.withColumn("r", F.rank().over(W.orderBy(F.desc("total_revenue")))).withColumn(
        "v", F.rank().over(W.orderBy(F.desc("total_orders")))
    )
    assert sorted(rows(found, "unit_key", "revenue_rank", "order_volume_rank")) == sorted(rows(ranks, "unit_key", "r", "v"))
    assert found.filter("unit_key = 4").count() == 0


def test_product_mart(spark):
    pick = random.Random(9)
    unit_of = {f"O{i}": pick.choice([1, 1, 2, 3]) for i in range(60)}
    sold = []
    for i in range(500):
        order, price, quantity = f"O{pick.randrange(60)}", Decimal(pick.randrange(100, 900)) / 100, pick.randrange(1, 5)
        sold.append((f"I{i}", order, date(2025, 1, 1 + pick.randrange(9)), unit_of[order], pick.choice([1, 1, 1, 2, 3]), quantity, price, price * quantity))
    fact = spark.createDataFrame(sold, ITEM_FACT)
    products = spark.createDataFrame([(k, k, f"P{k}") for k in (1, 2, 3, 4)], "product_key long, product_id long, product_name string")
    units = spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "unit_key long")
    found = marts.agg_product_performance(products, fact, units)
    literal = fact.groupBy("product_key").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("item_id").alias("total_line_items"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("total_item_value").cast("decimal(20,2)").alias("total_revenue"),
        F.count_distinct("unit_key").alias("units_selling_product"),
        F.round(F.count_distinct("unit_key") * 100 / F.lit(4), 2).alias("unit_penetration_pct"),
        F.min("order_date").alias("first_sold_date"),
        F.max("order_date").alias("last_sold_date"),
    )
    assert sorted(rows(found, *literal.columns)) == sorted(rows(literal))


@pytest.mark.parametrize("kind", ["distinct", "ties", "one value", "nulls", "empty", "single"])
def test_rank_equals_the_plain_window(spark, kind):
    pick = random.Random(3)
    values = {
        "distinct": [pick.random() * 1000 for _ in range(3000)],
        "ties": [float(pick.choice([1, 1, 1, 2, 3, 50])) for _ in range(3000)],
        "one value": [7.0] * 500,
        "nulls": [None if i % 5 == 0 else float(i % 40) for i in range(300)],
        "empty": [],
        "single": [4.0],
    }[kind]
    frame = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    plain = frame.withColumn("r", F.rank().over(W.orderBy(F.desc("v"))))
    assert sorted(rows(rank_descending(frame, {"r": "v"}), "id", "r")) == sorted(rows(plain, "id", "r"))


def test_rank_with_many_buckets(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "700")
    try:
        pick = random.Random(8)
        values = [None if pick.random() < 0.05 else Decimal(pick.randrange(-5000, 5000)) / 100 for _ in range(4000)]
        frame = spark.createDataFrame(list(enumerate(values)), "id long, v decimal(10,2)").coalesce(2)
        ranked = rank_descending(frame, {"r": "v"})
        spark.conf.set("spark.sql.shuffle.partitions", before)
        plain = frame.withColumn("r", F.rank().over(W.orderBy(F.desc("v"))))
        assert sorted(rows(ranked, "id", "r")) == sorted(rows(plain, "id", "r"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rank_does_not_gather_the_rows(spark):
    frame = spark.range(1000).withColumn("v", F.col("id") % 17)
    plan = rank_descending(frame, {"r": "v"})._jdf.queryExecution().executedPlan().toString()
    # the only single partition holds the bucket totals
    assert plan.count("Exchange SinglePartition") == 1
    assert "Window [sum(_size" in plan


def test_average_ignores_missing_fees_and_rounds_half_up(spark):
    values = [("1.00", None), ("1.01", "0.10"), ("1.01", "0.15")]
    fact = spark.createDataFrame(
        [(f"O{i}", "20250101", date(2025, 1, 1), 1, "ONLINE", "Finalizado", Decimal(v), f and Decimal(f), 1) for i, (v, f) in enumerate(values)],
        FACT,
    )
    found = marts.agg_daily_sales(dimensions.dim_date(spark, date(2025, 1, 1), date(2025, 1, 1)), fact)
    assert rows(found, "avg_order_value", "avg_delivery_fee", "online_pct") == [(Decimal("1.01"), Decimal("0.13"), 100.0)]


def test_days_cover_the_years_of_the_orders(spark):
    orders = spark.createDataFrame([(date(2025, 3, 1),), (date(2035, 6, 9),), (None,)], "order_date date")
    days = dimensions.dim_date_of(orders)
    assert rows(days.selectExpr("min(full_date)", "max(full_date)", "count(*)")) == [(date(2025, 1, 1), date(2035, 12, 31), 4017)]
    assert dimensions.dim_date_of(orders.limit(0)).count() == 0


def test_distinct_orders_of_products_are_counted_without_the_sums(spark):
    """Sums that went along with (product, unit, order) were shuffled with every row."""
    from conftest import plan_of

    from tillflow.operators import marts

    items = spark.createDataFrame(
        [(1, 7, "A", "a1", 2, 3), (1, 7, "A", "a2", 1, None), (1, 8, "B", "b1", None, 4), (None, None, None, "c1", 1, 1)],
        "product_key long, unit_key long, order_id string, item_id string, quantity long, price int",
    ).selectExpr("*", "CAST(price AS decimal(12,2)) unit_price", "CAST(price AS decimal(20,2)) total_item_value", "DATE '2026-01-01' order_date")
    found = marts.product_metrics(items)
    lines = [line for line in plan_of(found).splitlines() if "HashAggregate(keys=" in line and "order_id" in line.split("functions=")[0]]
    assert lines and all("functions=[]" in line for line in lines)
    shown = found.select("product_key", "total_orders", "units_selling_product", "item_count", "quantity_sum", "price_count").collect()
    assert sorted(map(tuple, shown), key=str) == [(1, 2, 2, 3, 3, 2), (None, 0, 0, 1, 1, 1)]
