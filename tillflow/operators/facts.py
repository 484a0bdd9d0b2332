"""Fact tables of the star schema: one per order, one per order item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.dates import date_key


def item_totals(items: DataFrame) -> DataFrame:
    """Item counts per order. The distinct count shuffles by order and product, so a huge order is spread."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_distinct("product_id").alias("distinct_products"),
        F.sum("quantity").alias("total_quantity"),
    )


def fact_sales(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their item counts; orders without items count zero. Unique orders give unique rows."""
    counts = ["total_items", "distinct_products", "total_quantity"]
    joined = orders.join(item_totals(items), "order_id", "left")
    return joined.select(
        "order_id",
        date_key(F.col("order_date")).alias("date_key"),
        "order_date",
        F.col("unit_id").alias("unit_key"),
        "order_type",
        "order_status",
        "order_value",
        "delivery_fee",
        "items_subtotal",
        *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in counts],
        "delivery_address",
        "_ingest_date",
    )


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with date, unit, type and status of their order."""
    context = orders.select("order_id", "order_date", "unit_id", "order_type", "order_status")
    return items.join(context, "order_id").select(
        F.col("order_item_id").alias("item_id"),
        "order_id",
        date_key(F.col("order_date")).alias("date_key"),
        "order_date",
        F.col("unit_id").alias("unit_key"),
        F.col("product_id").alias("product_key"),
        "quantity",
        "unit_price",
        "total_item_value",
        "order_type",
        "order_status",
        "observation",
        "_ingest_date",
    )
