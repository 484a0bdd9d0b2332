"""What the plans of the main queries look like, and that a hot key is split."""

from __future__ import annotations

import os

import pytest
from conftest import SMALL, executed_plan, rows
from pyspark.sql import functions as F

from tillflow.operators import facts, quality, silver
from tillflow.plans.queries import registry
from tillflow.plans.workspace import bench_workspace
from tillflow.sources.tables import TableStore

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no benchmark tables")
QUERIES = registry()


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_dedup", "stream_two_hour_rollup", "landing_orders", "landing_items"}))
def test_no_python_and_no_cartesian_product(spark, name):
    plan = physical(QUERIES[name](spark, SMALL))
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert word not in plan


@needs_data
@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("exec_total_revenue", {"total_revenue"}),
        ("exec_cancellation_rate", {"canceled_orders", "total_orders"}),
        ("units_avg_order_value", {"unit_key", "unit_name", "avg_order_value"}),
        ("dq_uniqueness", {"order_id"}),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    plan = physical(QUERIES[name](spark, SMALL))
    schema = plan[plan.index("ReadSchema: struct<") + len("ReadSchema: struct<") :]
    fields = schema[: schema.index("\n")].rstrip(">").replace("decimal(20,2)", "decimal").split(",")
    assert {f.split(":")[0] for f in fields} == columns


@needs_data
def test_status_filter_reaches_the_scan(spark):
    assert "IsNotNull(order_status), Not(EqualTo(order_status,Cancelado))" in physical(QUERIES["orders_value_histogram"](spark, SMALL))


@needs_data
@pytest.mark.parametrize("name", ["units_top_revenue", "prod_top_volume", "orders_top_orders", "latest_days", "star_join_top10"])
def test_top_k_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in physical(QUERIES[name](spark, SMALL))


@needs_data
def test_daily_mart_shuffles_partial_aggregates_only(spark):
    ws = bench_workspace(spark, SMALL)
    plan = physical(ws.compose("gold.agg_daily_sales"))
    assert "Expand" not in plan
    assert plan.count("partial_count(order_id") >= 1


@pytest.fixture
def eager_skew(spark):
    """Split joins at sizes that a test reaches."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_items(spark, store, hot: int = 60000, cold: int = 120000):
    """A third of all items belong to one order and one product."""
    wide = spark.range(hot + cold).repartition(16)
    is_hot = F.col("id") < hot
    items = wide.select(
        F.when(is_hot, "O0").otherwise(F.concat(F.lit("O"), F.col("id") % 5000)).alias("id_pedido"),
        F.concat(F.lit("I"), "id").alias("id_item_pedido"),
        F.when(is_hot, 0).otherwise(F.col("id") % 50).cast("long").alias("id_produto"),
        F.lit(1).cast("long").alias("qtd"),
        F.lit(2).cast("decimal(10,2)").alias("vlr_item"),
        F.sha2(F.col("id").cast("string"), 256).alias("observacao"),
        F.lit("f").alias("_source_file"),
        F.lit("2026-01-01").cast("timestamp").alias("_ingest_timestamp"),
        F.lit("2026-01-01").cast("date").alias("_ingest_date"),
    )
    orders = spark.range(5000).select(
        F.concat(F.lit("O"), "id").alias("order_id"),
        F.lit(1).cast("long").alias("unit_id"),
        F.lit("2026-01-01").cast("date").alias("order_date"),
        F.lit("ONLINE").alias("order_type"),
        F.lit("Finalizado").alias("order_status"),
    )
    store.write("t.items", items)
    store.write("t.orders", orders)
    return store.read("t.items"), store.read("t.orders")


def test_hot_order_is_split_in_both_item_joins(spark, store, eager_skew):
    items, orders = hot_items(spark, store)
    clean = silver.silver_order_items(items, orders)
    assert "isSkewJoin=true" in executed_plan(clean) or "skew=true" in executed_plan(clean)
    assert clean.count() == 180000
    store.write("t.silver", clean)
    fact = facts.fact_order_items(store.read("t.silver"), orders)
    assert "skew=true" in executed_plan(fact)
    assert fact.count() == 180000


def test_hot_order_is_combined_before_the_shuffle_of_item_totals(spark, store):
    items, orders = hot_items(spark, store)
    totals = facts.item_totals(silver.silver_order_items(items, orders))
    assert "Expand" not in physical(totals)
    assert rows(totals.filter("order_id = 'O0'"), "total_items")[0][0] > 60000


def test_orphans_are_counted_per_key_before_the_join(spark, store):
    items, _ = hot_items(spark, store)
    lost = quality.orphan_count(items, "id_produto", spark.range(1).select(F.col("id").alias("id_produto")))
    plan = physical(lost)
    assert plan.rindex("HashAggregate(keys=[id_produto") > plan.index("LeftOuter")
    assert rows(lost)[0][0] == items.filter("id_produto <> 0").count()


def test_hot_partition_is_split_when_written(spark, tmp_path):
    """A month that holds half of all rows is written by many tasks, the others by few."""
    changed = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB", "spark.sql.shuffle.partitions": "200"}
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        store = TableStore(spark, str(tmp_path))
        month = F.lpad((F.floor(F.col("id") / 2) % 12 + 1).cast("string"), 2, "0")
        frame = spark.range(300000).select(
            F.when(F.col("id") % 2 == 0, "2026-01").otherwise(F.concat(F.lit("2025-"), month)).alias("ym"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
        store.write("t.months", frame, "ym", ("text",))
        assert store.read("t.months").count() == 300000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

    def files(name: str) -> int:
        return sum(found.endswith(".parquet") for found in os.listdir(f"{store.path('t.months')}/ym={name}"))

    assert files("2026-01") >= 8  # a share is split along the tasks that produced it
    assert sorted(files(f"2025-{m:02d}") for m in range(1, 13))[6] <= 4


@needs_data
def test_large_tables_are_sorted_in_more_tasks_than_the_session_has_partitions(spark, tmp_path):
    """AQE merges partitions up to the advised size; with the 8 of this session it could not go beyond 8."""
    from tillflow.plans.workspace import Workspace
    from tillflow.sources import bench

    sizes = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    ws = Workspace(spark, lambda name: bench.BRONZE_TABLES[name](spark, SMALL), TableStore(spark, str(tmp_path / "t")))
    for name in sizes:
        spark.conf.set(name, "4k")
    try:
        assert ws.compose("silver.orders").rdd.getNumPartitions() > 8
    finally:
        for name in sizes:
            spark.conf.unset(name)


@needs_data
def test_a_single_check_writes_only_the_tables_it_reads(spark, tmp_path, monkeypatch):
    from tillflow.plans import queries
    from tillflow.plans.workspace import Workspace
    from tillflow.sources import bench

    ws = Workspace(spark, lambda name: bench.BRONZE_TABLES[name](spark, SMALL), TableStore(spark, str(tmp_path / "t")))
    monkeypatch.setattr(queries, "bench_workspace", lambda *_: ws)
    assert QUERIES["dq_uniqueness"](spark, SMALL).count() == 1
    assert set(ws.store.state()[1]["tables"]) == {"silver.orders", "silver.order_items", "gold.fact_sales"}
    for name in ("dq_freshness", "dq_completeness", "dq_accuracy", "dq_referential", "dq_volume_anomaly"):
        assert QUERIES[name](spark, SMALL).count() == 1


@needs_data
def test_checks_do_not_write_the_item_fact_of_which_one_reads_a_column(spark, tmp_path, monkeypatch):
    from tillflow.plans import queries
    from tillflow.plans.workspace import Workspace
    from tillflow.sources import bench

    ws = Workspace(spark, lambda name: bench.BRONZE_TABLES[name](spark, SMALL), TableStore(spark, str(tmp_path / "t")))
    monkeypatch.setattr(queries, "bench_workspace", lambda *_: ws)
    composed = {name: rows(QUERIES[name](spark, SMALL)) for name in ("dq_log_rows", "dq_latest", "dq_referential", "dq_referential_faulty")}
    assert len(composed["dq_log_rows"]) == len(composed["dq_latest"]) == 6
    tables = {"silver.orders", "silver.order_items", "silver.products", "gold.fact_sales", "gold.dim_product"}
    assert set(ws.store.state()[1]["tables"]) == tables
    ws.table("gold.fact_order_items")
    assert "order_ym" in ws.view("gold.fact_order_items").columns  # the written one, with its partition column
    assert {name: rows(QUERIES[name](spark, SMALL)) for name in composed} == composed
