"""Pre-aggregated tables per day, unit and product.

``orders_unique`` says that a sales fact holds every order once, which facts built by
:func:`tillflow.operators.facts.fact_sales` do. Distinct orders are then plain counts, which combine in
every task before the shuffle. Without that promise the orders are first brought to one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.numbers import TOTAL, count_where, mean, percent, ratio, total
from tillflow.operators.ranking import rank_descending
from tillflow.session import cut_lineage

_STATUS = {"completed_orders": "Finalizado", "canceled_orders": "Cancelado", "pending_orders": "Pendente"}


def _flags() -> dict[str, Column]:
    """The conditions whose orders are counted."""
    types = {"online_orders": "ONLINE", "physical_orders": "PHYSICAL"}
    flags = {name: F.col("order_type") == value for name, value in types.items()}
    return flags | {name: F.col("order_status") == value for name, value in _STATUS.items()}


def _sums() -> dict[str, Column]:
    value, flags = F.col("order_value"), _flags()
    return {
        "value_sum": F.sum(value),
        "value_count": F.count(value),
        "fee_sum": F.sum("delivery_fee"),
        "fee_count": F.count("delivery_fee"),
        "online_sum": F.sum(F.when(flags["online_orders"], value).otherwise(0)),
        "physical_sum": F.sum(F.when(flags["physical_orders"], value).otherwise(0)),
        "items_sum": F.sum("total_items"),
        "items_count": F.count("total_items"),
        "first_day": F.min("order_date"),
        "last_day": F.max("order_date"),
    }


def _merged(names) -> dict[str, Column]:
    """The aggregates that bring partial results of the same names together."""
    merge = {"first_day": F.min, "last_day": F.max}
    return {name: merge.get(name, F.sum)(name) for name in names}


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _order_metrics(fact: DataFrame, key: str, orders_unique: bool, by: str | None = None) -> DataFrame:
    """Sums, counts and distinct orders per ``key``; the columns not asked for are pruned by Catalyst.

    With unique orders, ``by`` counts the distinct values of another column in the same pass, as ``distinct_<by>``.
    """
    sums, flags, known = _sums(), _flags(), F.col("order_id").isNotNull()
    orders = {"total_orders": F.count("order_id")}
    if orders_unique:
        counts = {name: count_where(flag & known) for name, flag in flags.items()}
        if by:
            partial = orders | counts | sums
            per_group = fact.groupBy(key, by).agg(*_aliased(partial))
            groups = {f"distinct_{by}": F.count(by)}
            return per_group.groupBy(key).agg(*_aliased(_merged(partial) | groups))
        return fact.groupBy(key).agg(*_aliased(orders | counts | sums))
    held = {name: F.max(flag.cast("int")) for name, flag in flags.items()}
    per_order = fact.groupBy(key, "order_id").agg(*_aliased(held | sums))
    counts = {name: F.coalesce(F.sum(F.when(known, F.col(name))), F.lit(0)) for name in flags}
    return per_order.groupBy(key).agg(*_aliased(orders | counts | _merged(sums)))


def _money(name: str) -> Column:
    return F.round(F.col(name), 2).cast(TOTAL)


def _mean_of(what: str) -> Column:
    return ratio(F.col(f"{what}_sum"), F.col(f"{what}_count")).cast(TOTAL)


def agg_daily_sales(dim_date: DataFrame, fact_sales: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Sales per day, for the days of the date dimension that have orders, newest first."""
    if orders_unique:
        metrics = _order_metrics(fact_sales, "date_key", True, "unit_key").withColumnRenamed("distinct_unit_key", "active_units")
    else:
        units = fact_sales.groupBy("date_key").agg(F.count_distinct("unit_key").alias("active_units"))
        metrics = _order_metrics(fact_sales, "date_key", False).join(units, "date_key")
    metrics = metrics.filter(F.col("total_orders") > 0)
    days = dim_date.select(
        "date_key",
        F.col("full_date").alias("order_date"),
        "year",
        "month",
        "month_name",
        "year_month",
        "day_of_week_name",
        "is_weekend",
    )
    return (
        days.join(metrics, "date_key")
        .select(
            *days.columns,
            "total_orders",
            "online_orders",
            "physical_orders",
            _money("value_sum").alias("total_revenue"),
            _money("online_sum").alias("online_revenue"),
            _money("physical_sum").alias("physical_revenue"),
            _mean_of("value").alias("avg_order_value"),
            _money("fee_sum").alias("total_delivery_fees"),
            _mean_of("fee").alias("avg_delivery_fee"),
            F.col("items_sum").alias("total_items_sold"),
            _mean_of("items").cast("double").alias("avg_items_per_order"),
            "active_units",
            *_STATUS,
            percent(F.col("online_orders"), F.col("total_orders")).alias("online_pct"),
            percent(F.col("canceled_orders"), F.col("total_orders")).alias("cancellation_rate"),
        )
        .orderBy(F.desc("order_date"))
    )


def agg_unit_performance(dim_unit: DataFrame, fact_sales: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Sales per unit, for the units of the dimension that have orders, best revenue first.

    The fact is aggregated before the join, so the join is as large as the dimension and a unit with a
    huge share of the orders is already one row.
    """
    names = ("unit_key", "unit_id", "unit_name", "state_name", "country_name")
    metrics = _order_metrics(fact_sales, "unit_key", orders_unique).filter(F.col("total_orders") > 0)
    grouped = (
        dim_unit.select(*names)
        .join(metrics, "unit_key")
        .select(
            *names,
            "total_orders",
            "online_orders",
            "physical_orders",
            _money("value_sum").alias("total_revenue"),
            _mean_of("value").alias("avg_order_value"),
            F.col("items_sum").alias("total_items_sold"),
            _mean_of("items").cast("double").alias("avg_items_per_order"),
            "completed_orders",
            "canceled_orders",
            percent(F.col("canceled_orders"), F.col("total_orders")).alias("cancellation_rate"),
            percent(F.col("online_orders"), F.col("total_orders")).alias("online_pct"),
            F.col("first_day").alias("first_order_date"),
            F.col("last_day").alias("last_order_date"),
            (F.datediff("last_day", "first_day") + 1).alias("days_active"),
        )
    )
    ranks = {"revenue_rank": "total_revenue", "order_volume_rank": "total_orders"}
    return rank_descending(cut_lineage(grouped), ranks).orderBy(F.desc("total_revenue"), "unit_key")


def product_metrics(fact_items: DataFrame) -> DataFrame:
    """Per product: distinct orders, items and units, and the sums behind the averages.

    An item belongs to one order and an order to one unit, so counting up through (product, unit, order) and (product, unit)
    gives all distinct counts; a product or unit with a huge share of the rows is spread over all tasks by the finer key. The sums
    do not go along: nearly every row is a group of its own there, and they would be shuffled with every row, three times.
    """
    sums = {
        "item_count": F.count("item_id"),
        "quantity_sum": F.sum("quantity"),
        "quantity_count": F.count("quantity"),
        "value_sum": F.sum("total_item_value"),
        "value_count": F.count("total_item_value"),
        "price_sum": F.sum("unit_price"),
        "price_count": F.count("unit_price"),
        "first_day": F.min("order_date"),
        "last_day": F.max("order_date"),
    }
    distinct = ("total_orders", "units_selling_product")
    per_unit = fact_items.select("product_key", "unit_key", "order_id").distinct().groupBy("product_key", "unit_key").agg(F.count("order_id").alias("orders"))
    counted = per_unit.groupBy("product_key").agg(F.sum("orders").alias(distinct[0]), F.count("unit_key").alias(distinct[1]))
    summed = fact_items.groupBy("product_key").agg(*_aliased(sums))
    both = counted.unionByName(summed, allowMissingColumns=True)
    return both.groupBy("product_key").agg(*_aliased(_merged(distinct) | _merged(sums)))


def agg_product_performance(dim_product: DataFrame, fact_items: DataFrame, dim_unit: DataFrame) -> DataFrame:
    """Sales per product, for the products of the dimension that were sold, best revenue first.

    Line items are counted, not made distinct: the item fact holds every item once.
    """
    names = ("product_key", "product_id", "product_name")
    metrics = product_metrics(fact_items).filter(F.col("total_orders") > 0)
    unit_count = dim_unit.agg(F.count(F.lit(1))).scalar()
    grouped = (
        dim_product.select(*names)
        .join(metrics, "product_key")
        .select(
            *names,
            "total_orders",
            F.col("item_count").alias("total_line_items"),
            F.col("quantity_sum").alias("total_quantity_sold"),
            _mean_of("quantity").cast("double").alias("avg_quantity_per_order"),
            _money("value_sum").alias("total_revenue"),
            _mean_of("price").alias("avg_unit_price"),
            _mean_of("value").alias("avg_line_value"),
            "units_selling_product",
            percent(F.col("units_selling_product"), unit_count).alias("unit_penetration_pct"),
            F.col("first_day").alias("first_sold_date"),
            F.col("last_day").alias("last_sold_date"),
        )
    )
    ranks = {"revenue_rank": "total_revenue", "volume_rank": "total_quantity_sold"}
    return rank_descending(cut_lineage(grouped), ranks).orderBy(F.desc("total_revenue"), "product_key")


def product_unit_matrix(fact_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Distinct units per product name."""
    units = fact_items.groupBy("product_key").agg(F.count_distinct("unit_key").alias("unit_count"))
    return dim_product.select("product_key", "product_name").join(units, "product_key")


def fee_by_channel(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.groupBy("order_type").agg(
        mean(F.col("delivery_fee")).alias("avg_delivery_fee"), total(F.col("delivery_fee")).alias("total_delivery_fees")
    )


def units_by_day(fact_sales: DataFrame) -> DataFrame:
    """The units that sold something on a day as bitmaps, one row for each day and range of unit numbers.

    Bitmaps merge: those of a month are the union of its days', so distinct units of any span come from this table, without the
    fact. Units are whole numbers from 1 on; a bitmap covers 32,768 of them.
    """
    sold = fact_sales.filter("order_date IS NOT NULL AND unit_key IS NOT NULL")
    return sold.groupBy("order_date", F.bitmap_bucket_number("unit_key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("unit_key")).alias("units")
    )


def active_units(days: DataFrame, span: Column) -> DataFrame:
    """Distinct units for each value of ``span``, an expression of ``order_date``, from the bitmaps of the days."""
    merged = days.groupBy(span.alias("span"), "bucket").agg(F.bitmap_or_agg("units").alias("units"))
    return merged.groupBy("span").agg(F.sum(F.bitmap_count("units")).alias("active_units"))
