"""Dashboard and sample queries over marts and facts.

Every top-k query ends its order with a key that is unique, so that ties at the limit are decided the same
way on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.dates import weekday_position
from tillflow.functions.filters import NO_FILTERS, Filters
from tillflow.functions.numbers import TOTAL, mean, percent, ratio, total

# --- executive overview: the daily mart ---


def exec_total_revenue(daily: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return filters.dates(daily).agg(total(F.col("total_revenue")).alias("total_revenue"))


def exec_total_orders(daily: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return filters.dates(daily).agg(F.sum("total_orders").alias("total_orders"))


def exec_avg_order_value(daily: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """Ratio of the sums, not an average of daily averages."""
    value = ratio(F.sum("total_revenue"), F.sum("total_orders"))
    return filters.dates(daily).agg(value.alias("avg_order_value"))


def exec_cancellation_rate(daily: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    rate = percent(F.sum("canceled_orders"), F.sum("total_orders"))
    return filters.dates(daily).agg(rate.alias("cancellation_rate"))


def exec_revenue_trend(daily: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    columns = ("order_date", "total_revenue", "online_revenue", "physical_revenue")
    return filters.dates(daily).select(*columns).orderBy("order_date")


def exec_orders_by_channel(daily: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """One row per channel out of a single pass over the mart."""
    sums = filters.dates(daily).agg(F.sum("online_orders").alias("o"), F.sum("physical_orders").alias("p"))
    return sums.select(F.stack(F.lit(2), F.lit("Online"), F.col("o"), F.lit("Physical"), F.col("p"))).toDF(
        "channel", "orders"
    )


def exec_revenue_by_weekday(daily: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    days = filters.dates(daily).groupBy("day_of_week_name")
    sums = days.agg(total(F.col("total_revenue")).alias("total_revenue"), F.sum("total_orders").alias("total_orders"))
    return sums.orderBy(weekday_position(F.col("day_of_week_name")))


def exec_weekend_vs_weekday(daily: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    kind = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("period_type")
    return filters.dates(daily).groupBy(kind).agg(total(F.col("total_revenue")).alias("total_revenue"))


def latest_days(daily: DataFrame, limit: int = 5) -> DataFrame:
    columns = ("order_date", "total_orders", "total_revenue", "avg_order_value", "online_pct", "cancellation_rate")
    return daily.select(*columns).orderBy(F.desc("order_date")).limit(limit)


# --- unit performance: the unit mart ---


def _top(rows: DataFrame, measure: str, keys: list[str], limit: int, shown: Column | None = None) -> DataFrame:
    """The ``limit`` rows with the highest measure. ``shown`` is the measure as displayed."""
    name, *key = keys
    best = rows.orderBy(F.desc(measure), *key).limit(limit)
    return best.select(name, (F.col(measure) if shown is None else shown).alias(measure))


def _units(units: DataFrame, filters: Filters) -> DataFrame:
    return filters.choices(units, "state_name")


def units_top_revenue(units: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return _top(_units(units, filters), "total_revenue", ["unit_name", "unit_key"], 10)


def units_ranking(units: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return (
        _units(units, filters)
        .orderBy("revenue_rank", "unit_key")
        .select(
            "revenue_rank",
            "unit_name",
            "state_name",
            "total_orders",
            "total_revenue",
            "avg_order_value",
            F.round("cancellation_rate", 1).alias("cancellation_rate"),
            F.round("online_pct", 1).alias("online_pct"),
        )
    )


def units_online_pct(units: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    shown = F.round("online_pct", 1)
    return _top(_units(units, filters), "online_pct", ["unit_name", "unit_key"], 10, shown)


def units_cancellation_rate(units: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    some = _units(units, filters).filter(F.col("cancellation_rate") > 0)
    return _top(some, "cancellation_rate", ["unit_name", "unit_key"], 10, F.round("cancellation_rate", 1))


def units_revenue_by_state(units: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    sums = (
        _units(units, filters)
        .groupBy("state_name")
        .agg(
            total(F.col("total_revenue")).alias("total_revenue"),
            F.sum("total_orders").alias("total_orders"),
            F.count(F.lit(1)).alias("unit_count"),
        )
    )
    return sums.orderBy(F.desc("total_revenue"))


def units_avg_order_value(units: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return _top(_units(units, filters), "avg_order_value", ["unit_name", "unit_key"], 10)


# --- product analytics: the product mart ---


def _products(products: DataFrame, filters: Filters) -> DataFrame:
    return filters.choices(products, "product_name")


def prod_top_revenue(products: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return _top(_products(products, filters), "total_revenue", ["product_name", "product_key"], 10)


def prod_top_volume(products: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return _top(_products(products, filters), "total_quantity_sold", ["product_name", "product_key"], 10)


def prod_full_table(products: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return (
        _products(products, filters)
        .orderBy("revenue_rank", "product_key")
        .select(
            "revenue_rank",
            "product_name",
            "total_revenue",
            "total_quantity_sold",
            "total_orders",
            "avg_unit_price",
            F.round("unit_penetration_pct", 1).alias("unit_penetration_pct"),
        )
    )


def prod_unit_penetration(products: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    shown = F.round("unit_penetration_pct", 1)
    return _top(_products(products, filters), "unit_penetration_pct", ["product_name", "product_key"], 15, shown)


def prod_price_vs_revenue(products: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    columns = ("product_name", "avg_unit_price", "total_revenue", "total_quantity_sold")
    return _products(products, filters).select(*columns)


# --- order detail: the sales fact ---


def _orders(sales: DataFrame, filters: Filters, *columns: str) -> DataFrame:
    return filters.choices(filters.dates(sales), *columns)


def orders_delivery_fee_trend(sales: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    days = _orders(sales, filters, "order_type", "order_status").groupBy("order_date")
    fee = F.col("delivery_fee")
    return days.agg(mean(fee).alias("avg_delivery_fee"), total(fee).alias("total_delivery_fees")).orderBy("order_date")


def orders_value_histogram(sales: DataFrame, filters: Filters = NO_FILTERS, bins: int = 10) -> DataFrame:
    """Order values that were not canceled, counted in ``bins`` equal ranges from the lowest to the highest.

    A value on an inner edge counts in the upper range; the highest value counts in the last range.
    """
    kept = _orders(sales, filters, "order_type").filter(F.col("order_status") != "Cancelado").select("order_value")
    ends = kept.agg(F.struct(F.min("order_value").alias("low"), F.max("order_value").alias("high"))).scalar()
    edges = kept.select("order_value", ends["low"].alias("low"), ends["high"].alias("high"))
    # floor((value - low) * bins / (high - low)), in exact decimals
    position = F.floor((F.col("order_value") - F.col("low")) * bins / F.nullif(F.col("high") - F.col("low"), F.lit(0)))
    number = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int") + 1
    counted = edges.groupBy(number.alias("bin"), "low", "high").agg(F.count(F.lit(1)).alias("order_count"))
    width = (F.col("high") - F.col("low")) / bins
    return counted.select(
        "bin",
        F.round(F.col("low") + width * (F.col("bin") - 1), 2).alias("range_from"),
        F.round(F.col("low") + width * F.col("bin"), 2).alias("range_to"),
        "order_count",
    ).orderBy("bin")


def orders_status_breakdown(sales: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    statuses = _orders(sales, filters, "order_type").groupBy("order_status")
    return statuses.agg(F.count(F.lit(1)).alias("order_count")).orderBy(F.desc("order_count"), "order_status")


def orders_items_per_order(sales: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    kept = _orders(sales, filters, "order_type", "order_status")
    return kept.agg(mean(F.col("total_items")).cast("double").alias("avg_items_per_order"))


def orders_revenue_by_channel(sales: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    value = F.col("order_value")
    return (
        _orders(sales, filters, "order_status")
        .groupBy("order_type")
        .agg(
            total(value).alias("total_revenue"),
            F.count(F.lit(1)).alias("order_count"),
            mean(value).alias("avg_order_value"),
        )
    )


def orders_top_orders(sales: DataFrame, filters: Filters = NO_FILTERS, limit: int = 20) -> DataFrame:
    columns = ("order_id", "order_date", "order_type", "order_status", "total_items", "order_value", "delivery_fee")
    kept = _orders(sales, filters, "order_type", "order_status").select(*columns)
    return kept.orderBy(F.desc("order_value"), "order_id").limit(limit)


# --- chart wrapper and sample queries ---

# Rows that each kind of chart shows at most.
CHART_ROW_LIMITS = {"bar": 50, "pie": 100, "bubble": 100, "table": 1000, "line": 10000, "histogram": 10000}


def chart_rows(rows: DataFrame, dimensions: list[str], metrics: list[str], chart: str = "bar") -> DataFrame:
    """What a chart reads from a query: the highest metric per group, best first, up to the chart's limit.

    A line chart groups by the first dimension cut to days and runs in its order.
    """
    highest = [F.max(metric).alias(metric) for metric in metrics]
    if not dimensions:
        return rows.agg(*highest)
    if chart == "line":
        axis = dimensions[0]
        grouped = rows.withColumn(axis, F.to_date(axis)).groupBy(*dimensions).agg(*highest)
        return grouped.orderBy(*dimensions).limit(CHART_ROW_LIMITS[chart])
    grouped = rows.groupBy(*dimensions).agg(*highest)
    return grouped.orderBy(F.desc(metrics[0]), *dimensions).limit(CHART_ROW_LIMITS[chart])


def star_join_top10(
    sales: DataFrame, days: DataFrame, units: DataFrame, orders_unique: bool = False, limit: int = 10
) -> DataFrame:
    """Best (month, state, unit) groups by revenue.

    The fact is aggregated by month and unit key before the unit join; units of one name merge after it.
    """
    orders = F.count("order_id") if orders_unique else F.count_distinct("order_id")
    per_key = (
        sales.join(days.select("date_key", "year_month"), "date_key")
        .groupBy("year_month", "unit_key")
        .agg(orders.alias("orders"), F.sum("order_value").alias("value"), F.count("order_value").alias("values"))
    )
    named = per_key.join(units.select("unit_key", "state_name", "unit_name"), "unit_key")
    grouped = named.groupBy("year_month", "state_name", "unit_name").agg(
        F.sum("orders").alias("total_orders"),
        total(F.col("value")).alias("total_revenue"),
        ratio(F.sum("value"), F.sum("values")).cast(TOTAL).alias("avg_order_value"),
    )
    return grouped.orderBy(F.desc("total_revenue"), "year_month", "unit_name", "state_name").limit(limit)


def revenue_by_month(sales: DataFrame, days: DataFrame) -> DataFrame:
    """Orders and revenue per month: the fact is aggregated to days first, so the join has one row per day."""
    per_day = sales.groupBy("date_key").agg(F.count(F.lit(1)).alias("n"), F.sum("order_value").alias("value"))
    months = per_day.join(days.select("date_key", "year_month"), "date_key").groupBy("year_month")
    return months.agg(F.sum("n").alias("total_orders"), total(F.col("value")).alias("total_revenue")).orderBy(
        "year_month"
    )


def fact_detail_sample(sales: DataFrame, days: DataFrame, units: DataFrame, limit: int = 10) -> DataFrame:
    detail = sales.join(days.select("date_key", "full_date"), "date_key").join(
        units.select("unit_key", "unit_name"), "unit_key"
    )
    first = detail.orderBy("full_date", "order_id").limit(limit)
    return first.select("full_date", "unit_name", "order_id", "order_value")


def item_breakdown(items: DataFrame, products: DataFrame) -> DataFrame:
    named = items.join(products.select("product_key", "product_name"), "product_key", "left")
    return named.select("order_id", "item_id", "product_name", "quantity", "unit_price", "total_item_value")
