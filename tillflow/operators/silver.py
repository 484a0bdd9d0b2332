"""Cleaned, typed and de-duplicated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.functions.text import blank_to_null

LINEAGE = ("_source_file", "_ingest_timestamp", "_ingest_date")


def latest_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The row of each key that came in last.

    Equal ingest times are decided by the source file and then by the other columns, so that a rebuild
    gives the same rows. Spark keeps one row per key in every task before the shuffle (WindowGroupLimit),
    hence a key that was delivered over and over does not pile up in one task.
    """
    order = ["_ingest_timestamp", "_source_file"]
    order += [name for name in rows.columns if name not in (key, *order)]
    newest_first = W.partitionBy(key).orderBy(*[F.desc(name) for name in order])
    return rows.withColumn("_nth", F.row_number().over(newest_first)).filter(F.col("_nth") == 1).drop("_nth")


def _reference(rows: DataFrame, key: str, columns: dict[str, Column], as_of) -> DataFrame:
    updated = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    named = [expr.alias(name) for name, expr in columns.items()]
    return rows.filter(F.col(key).isNotNull()).select(*named, updated.alias("_updated_at"))


def silver_products(products: DataFrame, as_of=None) -> DataFrame:
    columns = {"product_id": F.col("id_produto"), "product_name": F.trim("nome_produto")}
    return _reference(products, "id_produto", columns, as_of)


def silver_states(states: DataFrame, as_of=None) -> DataFrame:
    columns = {
        "state_id": F.col("id_estado"),
        "country_id": F.col("id_pais"),
        "state_name": F.trim("nome_estado"),
    }
    return _reference(states, "id_estado", columns, as_of)


def silver_countries(countries: DataFrame, as_of=None) -> DataFrame:
    columns = {"country_id": F.col("id_pais"), "country_name": F.trim("nome_pais")}
    return _reference(countries, "id_pais", columns, as_of)


def silver_units(units: DataFrame, states: DataFrame, countries: DataFrame, as_of=None) -> DataFrame:
    """Units with the names of their state and of that state's country; unmatched ones stay with nulls.

    States are joined to countries first, so the large side is shuffled at most once. Which side is
    broadcast is left to Spark, which knows the sizes.
    """
    places = (
        states.alias("s")
        .join(countries.alias("c"), F.col("s.id_pais") == F.col("c.id_pais"), "left")
        .select("s.id_estado", "s.nome_estado", "c.id_pais", "c.nome_pais")
    )
    located = units.alias("u").join(places.alias("p"), F.col("u.id_estado") == F.col("p.id_estado"), "left")
    columns = {
        "unit_id": F.col("u.id_unidade"),
        "unit_name": F.trim("u.nome_unidade"),
        "state_id": F.col("p.id_estado"),
        "state_name": F.trim("p.nome_estado"),
        "country_id": F.col("p.id_pais"),
        "country_name": F.trim("p.nome_pais"),
    }
    return _reference(located, "u.id_unidade", columns, as_of)


def order_type(raw_type: Column) -> Column:
    """ONLINE or PHYSICAL when the text says so in any case; everything else, null included, is UNKNOWN."""
    upper = F.upper(raw_type)
    return F.when(upper.contains("ONLINE"), "ONLINE").when(upper.contains("FISIC"), "PHYSICAL").otherwise("UNKNOWN")


def silver_orders(orders: DataFrame) -> DataFrame:
    day, value, fee = F.col("data_pedido"), F.col("vlr_pedido"), F.col("taxa_entrega")
    address = F.when(F.col("tipo_pedido") == "Loja Online", blank_to_null(F.col("endereco_entrega")))
    return latest_per_key(orders, "id_pedido").select(
        F.col("id_pedido").alias("order_id"),
        F.col("id_unidade").alias("unit_id"),
        order_type(F.col("tipo_pedido")).alias("order_type"),
        F.col("status").alias("order_status"),
        day.alias("order_date"),
        F.year(day).alias("order_year"),
        F.month(day).alias("order_month"),
        F.dayofmonth(day).alias("order_day"),
        F.date_format(day, "EEEE").alias("order_day_of_week"),
        F.round(value, 2).alias("order_value"),
        F.round(fee, 2).alias("delivery_fee"),
        F.round(value - fee, 2).alias("items_subtotal"),
        address.alias("delivery_address"),
        *LINEAGE,
    )


def silver_order_items(items: DataFrame, orders: DataFrame, *also: str) -> DataFrame:
    """Items of known orders, newest delivery of each, and the columns ``also`` of their order.

    ``orders`` is the silver order table: it holds exactly the order ids of bronze, each once. A semi join
    against it neither fans out nor needs a distinct, and its two sides are plain shuffles, so AQE can split
    an order that holds a large share of all items.
    """
    known = items.join(
        orders.select(F.col("order_id").alias("id_pedido"), *also),
        "id_pedido",
        "inner" if also else "left_semi",
    )
    quantity, price = F.col("qtd").cast("long"), F.col("vlr_item")
    return latest_per_key(known, "id_item_pedido").select(
        F.col("id_item_pedido").alias("order_item_id"),
        F.col("id_pedido").alias("order_id"),
        F.col("id_produto").alias("product_id"),
        quantity.alias("quantity"),
        F.round(price, 2).alias("unit_price"),
        F.round(quantity * price, 2).cast("decimal(20,2)").alias("total_item_value"),
        blank_to_null(F.col("observacao")).alias("observation"),
        *LINEAGE,
        *also,
    )


def items_enriched(items: DataFrame, orders: DataFrame, products: DataFrame, units: DataFrame) -> DataFrame:
    """Items with product and unit names and the date parts of their order, where those are known."""
    dated = items.join(orders.select("order_id", "unit_id", "order_date"), "order_id", "left")
    named = dated.join(products.select("product_id", "product_name"), "product_id", "left").join(
        units.select("unit_id", "unit_name", "state_name"), "unit_id", "left"
    )
    return named.select(
        F.col("order_item_id").alias("item_id"),
        "order_id",
        "order_date",
        "unit_price",
        "quantity",
        "product_name",
        "unit_name",
        "state_name",
        F.year("order_date").alias("year"),
        F.month("order_date").alias("month"),
        F.date_format("order_date", "EEEE").alias("day_of_week"),
    )
