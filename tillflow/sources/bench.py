"""The bronze tables of a folder of benchmark tables (region, nation, customer, part, orders, lineitem, events).

Each function maps one table, whole, onto a bronze schema. Where the benchmark data is too clean to exercise
an operator, the mapping spoils some values by a rule on the row: blank addresses, missing fees, re-delivered
orders, items whose order never came, text that is not a number.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.schemas import BRONZE, MONEY, FileSpec

REFERENCE_LOADED_AT = datetime(2002, 1, 1)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _padded(text: Column) -> Column:
    return F.concat(F.lit("  "), text, F.lit(" "))


def _as_bronze(rows: DataFrame, table: str, **columns: Column) -> DataFrame:
    kinds = {f.name: f.dataType for f in BRONZE[table]}
    return rows.select(*[columns[name].cast(kind).alias(name) for name, kind in kinds.items()])


def _loaded_at() -> Column:
    return F.lit(REFERENCE_LOADED_AT.isoformat(sep=" ")).cast("timestamp")


def countries(spark: SparkSession, folder: str) -> DataFrame:
    return _as_bronze(
        load(spark, folder, "region"),
        "countries",
        id_pais=F.col("r_regionkey"),
        nome_pais=_padded(F.col("r_name")),
        _ingest_timestamp=_loaded_at(),
    )


def states(spark: SparkSession, folder: str) -> DataFrame:
    return _as_bronze(
        load(spark, folder, "nation"),
        "states",
        id_estado=F.col("n_nationkey"),
        id_pais=F.col("n_regionkey"),
        nome_estado=_padded(F.col("n_name")),
        _ingest_timestamp=_loaded_at(),
    )


def units(spark: SparkSession, folder: str) -> DataFrame:
    return _as_bronze(
        load(spark, folder, "customer"),
        "units",
        id_unidade=F.col("c_custkey"),
        nome_unidade=_padded(F.col("c_name")),
        id_estado=F.col("c_nationkey"),
        _ingest_timestamp=_loaded_at(),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _as_bronze(
        load(spark, folder, "part"),
        "products",
        id_produto=F.col("p_partkey"),
        nome_produto=_padded(F.col("p_name")),
        _ingest_timestamp=_loaded_at(),
    )


def _choose(column: Column, values: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(column == key, F.lit(value)) for key, value in values.items()])


def _online(priority: Column) -> Column:
    return priority.isin("1-URGENT", "2-HIGH", "3-MEDIUM")


def _order_columns() -> dict[str, Column]:
    key, day, priority = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("o_orderpriority")
    fee = ((F.lit(500) + key % 2001).cast("decimal(12,2)") / 100).cast(MONEY)
    address = F.when(key % 10 == 0, F.lit("   ")).otherwise(
        F.concat(F.lit("  Rua "), F.col("o_custkey").cast("string"), F.lit("  "))
    )
    return {
        "id_unidade": F.col("o_custkey"),
        "id_pedido": key.cast("string"),
        "tipo_pedido": F.when(_online(priority), "Loja Online").when(priority == "5-LOW", "Loja Fisica").otherwise("Balcao"),
        "data_pedido": day,
        "vlr_pedido": F.col("o_totalprice").cast(MONEY),
        "endereco_entrega": F.when(_online(priority), address),
        "taxa_entrega": F.when(_online(priority), fee).when(priority == "5-LOW", F.lit(0).cast(MONEY)),
        "status": _choose(F.col("o_orderstatus"), {"F": "Finalizado", "O": "Pendente", "P": "Cancelado"}),
        "_source_file": F.concat(F.lit("raw/csv_sales/"), F.date_format(day, "yyyy/MM/dd"), F.lit("/pedido.csv")),
        "_ingest_timestamp": F.date_add(day, 1).cast("timestamp"),
        "_ingest_date": F.date_add(day, 1),
    }


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as delivered, and urgent pending ones delivered again two days later as canceled."""
    source, columns = load(spark, folder, "orders"), _order_columns()
    again = columns | {
        "status": F.lit("Cancelado"),
        "_ingest_timestamp": F.date_add(F.to_date("o_orderdate"), 3).cast("timestamp"),
        "_ingest_date": F.date_add(F.to_date("o_orderdate"), 3),
    }
    pending = source.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))
    return _as_bronze(source, "orders", **columns).unionByName(_as_bronze(pending, "orders", **again))


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """All line items; returned seventh lines point at an order that never came."""
    day, line = F.to_date("l_shipdate"), F.col("l_linenumber")
    order = F.col("l_orderkey").cast("string")
    lost = (F.col("l_returnflag") == "R") & (line == 7)
    note = F.when(line % 3 == 1, F.lit("  ")).when(line % 3 == 2, F.concat(F.lit(" obs "), line.cast("string"), F.lit(" ")))
    return _as_bronze(
        load(spark, folder, "lineitem"),
        "order_items",
        id_pedido=F.when(lost, F.concat(F.lit("lost-"), order)).otherwise(order),
        id_item_pedido=F.concat(order, F.lit("-"), line.cast("string")),
        id_produto=F.col("l_partkey"),
        qtd=F.col("l_quantity"),
        vlr_item=F.col("l_extendedprice").cast(MONEY),
        observacao=note,
        _source_file=F.concat(F.lit("raw/csv_sales/"), F.date_format(day, "yyyy/MM/dd"), F.lit("/item_pedido.csv")),
        _ingest_timestamp=day.cast("timestamp"),
        _ingest_date=day,
    )


BRONZE_TABLES = {
    "bronze.countries": countries,
    "bronze.states": states,
    "bronze.units": units,
    "bronze.products": products,
    "bronze.orders": orders,
    "bronze.order_items": order_items,
}


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as the text cells of monthly files. Some cells are spoiled, urgent pending orders come twice, and
    no date of February 1996 can be read."""
    source = load(spark, folder, "orders")
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    columns = _order_columns()
    text = {name: columns[name].cast("string") for name in ("id_unidade", "id_pedido", "tipo_pedido", "endereco_entrega", "taxa_entrega")}
    bad_day = (key % 83 == 0) | (F.date_format(day, "yyyy-MM") == "1996-02")
    value = F.col("o_totalprice").cast(MONEY).cast("string")
    rows = source.select(
        text["id_unidade"].alias("Id_Unidade"),
        text["id_pedido"].alias("Id_Pedido"),
        text["tipo_pedido"].alias("Tipo_Pedido"),
        F.when(bad_day, "invalid-date").otherwise(F.date_format(day, "yyyy-MM-dd")).alias("Data_Pedido"),
        F.when(key % 97 == 0, "not_a_number").when(key % 89 == 0, "NA").otherwise(value).alias("Vlr_Pedido"),
        text["endereco_entrega"].alias("Endereco_Entrega"),
        text["taxa_entrega"].alias("Taxa_Entrega"),
        F.when(key % 79 == 0, "Entregue").otherwise(columns["status"]).alias("Status"),
        F.concat(F.lit("raw/csv_sales/"), F.date_format(day, "yyyy/MM"), F.lit("/pedido.csv")).alias("_source_file"),
        key.alias("_row"),
        ((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")).alias("_twice"),
    )
    again = rows.filter("_twice").withColumn("_row", F.col("_row") + 10**15).withColumn("Status", F.lit("Cancelado"))
    return rows.unionByName(again).drop("_twice")


def raw_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as the text cells of monthly files; line keys repeat in the source, some cells are spoiled."""
    key, line, day = F.col("l_orderkey"), F.col("l_linenumber"), F.to_date("l_shipdate")
    price = F.col("l_extendedprice").cast(MONEY).cast("string")
    return load(spark, folder, "lineitem").select(
        key.cast("string").alias("Id_Pedido"),
        F.concat(key.cast("string"), F.lit("-"), line.cast("string")).alias("Id_Item_Pedido"),
        F.when(key % 71 == 0, "").otherwise(F.col("l_partkey").cast("string")).alias("Id_Produto"),
        F.when(key % 73 == 0, "two").otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("Qtd"),
        F.when(key % 67 == 0, "nan").otherwise(price).alias("Vlr_Item"),
        F.lit(None).cast("string").alias("Observacao"),
        F.concat(F.lit("raw/csv_sales/"), F.date_format(day, "yyyy/MM"), F.lit("/item_pedido.csv")).alias("_source_file"),
        # a position within the file that is the same on every read: day, then product
        (F.unix_date(day).cast("bigint") * 10**12 + F.col("l_partkey")).alias("_row"),
    )


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Events as metric samples. Their values have two decimals; they are kept as exact decimals."""
    return load(spark, folder, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("host"),
        F.col("event_type").alias("name"),
        F.col("value").cast("decimal(18,2)").alias("value"),
    )


def rule_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The same samples under the names of the metrics that the alert rules watch."""
    names = {"view": "cpu_pct", "click": "memory_pct", "error": "disk_pct", "signup": "exporter_up", "purchase": "targets_up"}
    return samples(spark, folder).withColumn("name", _choose(F.col("name"), names))


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a file listing: one file per event, value as size in KiB."""
    sample = samples(spark, folder)
    day = F.date_format("ts", "yyyy/MM/dd")
    return sample.select(
        F.concat(F.lit("raw/csv_sales/"), day, F.lit("/"), F.col("event_id").cast("string"), F.lit(".csv")).alias("path"),
        F.when(F.col("name").isin("view", "click"), "objects").otherwise("warehouse").alias("store"),
        (F.col("value") * 1024).cast("bigint").alias("length"),
        F.col("ts").alias("modificationTime"),
    )


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a query log: value as GiB read; errors and clicks did not finish."""
    state = F.when(F.col("name") == "error", "FAILED").when(F.col("name") == "click", "RUNNING").otherwise("DONE")
    return samples(spark, folder).select(
        F.col("ts").alias("creation_time"), state.alias("state"), (F.col("value") * 1024**3).cast("bigint").alias("bytes")
    )


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as run events of scheduled jobs."""
    kinds = {"error": "task_failure", "click": "sla_miss", "view": "quality_failure"}
    return load(spark, folder, "events").select(
        _choose(F.col("event_type"), kinds).alias("kind"),
        F.concat(F.lit("dag_"), F.col("user_id").cast("string")).alias("dag_id"),
        F.concat(F.lit("run_"), F.col("event_id").cast("string")).alias("dag_run_id"),
        F.col("event_type").alias("task_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("props").alias("error"),
        F.array(F.lit("freshness"), F.col("event_type")).alias("checks"),
    )


def dotted_names(spark: SparkSession, folder: str) -> DataFrame:
    """Events under the dotted metric names of a job scheduler."""
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    name = (
        F.when(kind == "view", F.concat(F.lit("airflow.dag.dag_"), user, F.lit(".load.duration")))
        .when(kind == "click", F.concat(F.lit("airflow.dagrun.duration.dag_"), user, F.lit(".run_1.success")))
        .when(kind == "error", F.concat(F.lit("airflow.ti.finish.dag_"), user, F.lit(".load.failed")))
        .when(kind == "signup", F.concat(F.lit("airflow.queue_"), user))
        .otherwise(F.lit("airflow.scheduler.tasks.running"))
    )
    return load(spark, folder, "events").select("event_id", name.alias("dotted"))


#: Rows of a landing file, on average; a row has some 80 to 350 bytes, and files stay below the limit of 10 MB.
PART_ROWS = 15_000


def landing_texts(raw: DataFrame, spec: FileSpec) -> DataFrame:
    """The text of each file of a raw frame, as ``year, month, part, value``.

    A month is dealt by key to files of some PART_ROWS rows, so that no file nears the size limit of landing files however
    large the table is, and rows of equal keys stay in one file, in their order.

    Files of 1997 have forty more columns in front, those of 1998 an unnamed one in the middle, and the first one
    of 1999 lacks its last column.
    """
    year, month = F.split("_source_file", "/")[2], F.split("_source_file", "/")[3]
    cells = [F.coalesce(F.col(name), F.lit("")) for name in spec.columns]
    extra = [F.lit(";".join(f"x{i}" for i in range(40)))]

    def line(parts: list[Column]) -> Column:
        plain, wide = F.concat_ws(";", *parts), F.concat_ws(";", *extra, *parts)
        gap = F.concat_ws(";", *parts[:2], F.lit(""), *parts[2:])
        short = F.concat_ws(";", *parts[:-1])
        special = F.when(year == "1997", wide).when(year == "1998", gap).when((year == "1999") & (month == "01"), short)
        return special.otherwise(plain)

    lines = raw.select(
        year.alias("year"),
        month.alias("month"),
        F.xxhash64(spec.key).alias("_hash"),
        "_row",
        line(cells).alias("line"),
        line([F.lit(c) for c in spec.columns]).alias("head"),
    )
    parts = lines.groupBy("year", "month").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("_parts"))
    part = F.format_string("shop-%06d", F.pmod("_hash", "_parts"))
    dealt = lines.join(parts, ["year", "month"]).withColumn("part", part)
    files = dealt.groupBy("year", "month", "part").agg(
        F.sort_array(F.collect_list(F.struct("_row", "line"))).alias("lines"), F.first("head").alias("head")
    )
    body = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return files.select("year", "month", "part", F.concat("head", F.lit("\n"), body).alias("value"))


def month_file(path: Column) -> Column:
    """The name of the month that a part file of :func:`landing_texts` belongs to."""
    return F.regexp_replace(path, "/shop-[0-9]+/", "/")


LATE_FROM = date(1997, 6, 1)


def sales_loads(spark: SparkSession, folder: str) -> list[dict[str, DataFrame]]:
    """The bronze sales as two loads, which together have the rows of the tables above as the newest of each key.

    In the first one some of the later orders are missing, others have a wrong day and value, and some items have a wrong
    quantity; the second one brings the late and the corrected rows, and repeats others as they were.
    """
    all_orders, all_items = orders(spark, folder), order_items(spark, folder)
    key = F.col("id_pedido").cast("bigint") % 10
    late = F.col("data_pedido") >= F.lit(LATE_FROM)
    wrong = {
        "data_pedido": F.date_sub("data_pedido", 45),
        "vlr_pedido": F.lit(1).cast(MONEY),
        "_ingest_timestamp": F.col("_ingest_timestamp") - F.expr("INTERVAL 5 DAYS"),
        "_ingest_date": F.date_sub("_ingest_date", 5),
    }
    first_orders = all_orders.filter(~late | ~key.isin(3, 7)).unionByName(all_orders.filter(late & (key == 7)).withColumns(wrong))
    second_orders = all_orders.filter(late & key.isin(1, 3, 7))

    item_key = F.split("id_item_pedido", "-")[0].cast("bigint") % 10
    late_item = F.col("_ingest_date") >= F.lit(LATE_FROM)
    held = late_item & (item_key.isin(2, 5) & F.col("id_item_pedido").endswith("-2"))
    spoiled = {
        "qtd": F.lit(999).cast("bigint"),
        "_ingest_timestamp": F.col("_ingest_timestamp") - F.expr("INTERVAL 5 DAYS"),
        "_ingest_date": F.date_sub("_ingest_date", 5),
    }
    first_items = all_items.filter(~held).unionByName(all_items.filter(held & (item_key == 5)).withColumns(spoiled))
    second_items = all_items.filter(held | (late_item & (item_key == 1)))
    return [{"bronze.orders": first_orders, "bronze.order_items": first_items}, {"bronze.orders": second_orders, "bronze.order_items": second_items}]
