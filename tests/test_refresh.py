"""Incremental refresh against the full rebuild, and facts from tables stored by order id."""

from __future__ import annotations

import time
import uuid
from datetime import date, datetime

import pytest
from conftest import SMALL, executed_plan, rows
from pyspark.sql import functions as F

from tillflow.functions.filters import MONTH_PARTITION
from tillflow.operators import facts, silver
from tillflow.plans import copartitioned, refresh
from tillflow.plans.workspace import MARTS, Workspace
from tillflow.sources import bench

SALES = ("bronze.orders", "bronze.order_items")


def workspace(spark, store):
    def bronze(name):
        return store.read(name) if name in SALES else bench.BRONZE_TABLES[name](spark, SMALL)

    return Workspace(spark, bronze, store, as_of=bench.REFERENCE_LOADED_AT)


def load(store, number, orders, items):
    with store.transaction(("sales", number)) as changes:
        changes.append("bronze.orders", orders, "_ingest_date")
        changes.append("bronze.order_items", items, "_ingest_date")


def assert_like_a_rebuild(spark, ws, tmp_path):
    """Every table that a refresh keeps, against a rebuild from the same bronze in a store of its own."""
    from tillflow.sources.tables import TableStore

    other = TableStore(spark, str(tmp_path / uuid.uuid4().hex))
    load(other, 0, ws.store.read("bronze.orders"), ws.store.read("bronze.order_items"))
    full = workspace(spark, other)
    refresh.rebuild(full)
    for name in dict.fromkeys((*refresh.MONTHLY, refresh.WAITING, *MARTS)):
        mine, theirs = ws.store.read(name), other.read(name)
        if name == refresh.WAITING:
            mine, theirs = mine.distinct(), theirs.distinct()
        assert sorted(map(str, mine.select(*theirs.columns).collect())) == sorted(map(str, theirs.collect())), name


def at(day, hour=0):
    return datetime(2026, *day, hour)


def test_late_repeated_corrected_and_moved_rows(spark, store, bronze_orders, bronze_items, tmp_path):
    def order(key, day, came, **more):
        return {"id_pedido": key, "data_pedido": date(2026, *day), "_ingest_timestamp": at(came), "_ingest_date": date(2026, *came)} | more

    def item(key, of, came, **more):
        return {"id_item_pedido": key, "id_pedido": of, "_ingest_timestamp": at(came), "_ingest_date": date(2026, *came)} | more

    load(
        store, 0,
        bronze_orders(order("A", (1, 5), (1, 6)), order("B", (2, 5), (2, 6)), order("C", (3, 5), (3, 6)), order("D", (4, 5), (4, 6))),
        bronze_items(item("1", "A", (1, 6)), item("2", "B", (2, 6)), item("3", "C", (3, 6)), item("9", "late", (1, 7)), item("8", "never", (1, 7))),
    )
    ws = workspace(spark, store)
    assert refresh.refresh(ws) == refresh.Refreshed(True, ())
    assert refresh.refresh(ws) == refresh.Refreshed(False, ())
    load(
        store, 1,
        bronze_orders(
            order("late", (1, 4), (4, 7)),  # its item has waited
            order("A", (1, 5), (1, 6)),  # as it was
            order("B", (3, 1), (4, 7), vlr_pedido="1.00"),  # another month, with its item
            order("B", (2, 9), (2, 5)),  # an older delivery that comes last
        ),
        bronze_items(item("3", "A", (4, 7), qtd=5)),  # another order
    )
    done = refresh.refresh(ws)
    assert done == refresh.Refreshed(False, ("2026-01", "2026-02", "2026-03"))
    sales = {r["order_id"]: r for r in store.read("gold.fact_sales").collect()}
    assert (sales["late"]["total_items"], sales["C"]["total_items"], sales["A"]["total_quantity"]) == (1, 0, 7)
    assert sales["B"][MONTH_PARTITION] == "2026-03"
    load(store, 2, bronze_orders(), bronze_items(item("7", "D", (4, 8)), item("6", "unheard", (4, 8))))
    assert refresh.refresh(ws).months == ("2026-04",)
    assert_like_a_rebuild(spark, ws, tmp_path)


def test_a_refresh_that_fails_leaves_all_tables(spark, store, bronze_orders, bronze_items, monkeypatch, tmp_path):
    from tillflow.sources.tables import Transaction

    load(store, 0, bronze_orders({"id_pedido": "A"}), bronze_items({"id_item_pedido": "1", "id_pedido": "A"}))
    ws = workspace(spark, store)
    refresh.refresh(ws)
    before = {name: rows(store.read(name)) for name in refresh.MONTHLY}
    load(store, 1, bronze_orders({"id_pedido": "B"}), bronze_items({"id_item_pedido": "2", "id_pedido": "B"}))
    replace = Transaction.replace_partitions

    def failing(self, name, *args, **options):
        replace(self, name, *args, **options)
        if name == "gold.fact_sales":
            raise RuntimeError("killed")

    monkeypatch.setattr(Transaction, "replace_partitions", failing)
    with pytest.raises(RuntimeError, match="killed"):
        refresh.refresh(ws)
    assert {name: rows(store.read(name)) for name in refresh.MONTHLY} == before
    monkeypatch.setattr(Transaction, "replace_partitions", replace)
    assert refresh.refresh(ws).months == ("2026-01",)
    assert sorted(rows(store.read("gold.fact_sales"), "order_id", "total_items")) == [("A", 1), ("B", 1)]


def test_a_store_can_keep_a_part_of_the_tables(spark, store, bronze_orders, bronze_items, tmp_path):
    load(store, 0, bronze_orders({"id_pedido": "A"}, {"id_pedido": "B", "data_pedido": date(2026, 2, 1)}), bronze_items({"id_item_pedido": "1", "id_pedido": "A"}, {"id_item_pedido": "2", "id_pedido": "C"}))
    ws = workspace(spark, store)
    assert refresh.refresh(ws, ("silver.orders",)).rebuilt
    load(store, 1, bronze_orders({"id_pedido": "C"}), bronze_items({"id_item_pedido": "3", "id_pedido": "B"}))
    assert refresh.refresh(ws, ("silver.orders",)) == refresh.Refreshed(False, ("2026-01",))
    assert sorted(rows(store.read("silver.orders"), "order_id")) == [("A",), ("B",), ("C",)]
    assert set(store.state()[1]["tables"]) == {*SALES, "silver.orders"}
    sales = ("gold.fact_sales",)
    assert refresh.refresh(ws, sales).rebuilt
    load(store, 2, bronze_orders(), bronze_items({"id_item_pedido": "4", "id_pedido": "A"}))
    assert refresh.refresh(ws, sales) == refresh.Refreshed(False, ("2026-01",))
    assert set(store.state()[1]["tables"]) == {*SALES, "silver.orders", "silver.order_items", refresh.WAITING, *sales}
    assert sorted(rows(store.read(*sales), "order_id", "total_items")) == [("A", 2), ("B", 1), ("C", 1)]
    # other tables were refreshed last, so all are built anew
    assert refresh.refresh(ws).rebuilt and refresh.refresh(ws) == refresh.Refreshed(False, ())
    assert_like_a_rebuild(spark, ws, tmp_path)


def test_items_take_their_month_from_the_join_with_their_orders(spark, store, bronze_orders, bronze_items):
    """Items are joined to orders once, not a second time for the month."""
    load(store, 0, bronze_orders({"id_pedido": "A"}), bronze_items({"id_item_pedido": "1", "id_pedido": "A"}))
    ws = workspace(spark, store)
    refresh.refresh(ws)
    built = ws.compose("silver.order_items")
    assert executed_plan(built).count("Join") == executed_plan(silver.silver_order_items(ws.table("bronze.order_items"), ws.table("silver.orders"))).count("Join")
    assert rows(built, "order_item_id", MONTH_PARTITION) == [("1", "2026-01")]


def test_a_refresh_shuffles_items_once_by_order_and_once_by_id(spark, store, bronze_orders, bronze_items, monkeypatch):
    """Which of them may change is found where the newest of each lie already; repeated waiting items are looked for among those that still wait."""
    from tillflow.sources.tables import Transaction

    load(store, 0, bronze_orders({"id_pedido": "A"}), bronze_items({"id_item_pedido": "1", "id_pedido": "A"}))
    ws = workspace(spark, store)
    refresh.refresh(ws, ("silver.order_items",))
    load(store, 1, bronze_orders({"id_pedido": "B"}), bronze_items({"id_item_pedido": "2", "id_pedido": "B"}, {"id_item_pedido": "3", "id_pedido": "never"}))
    plans = {}
    stage, replace = refresh.stage, Transaction.replace

    def planned(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    def staging(frame):
        if "quantity" in frame.columns:
            plans["items"] = planned(frame)
        return stage(frame)

    def replacing(self, name, rows, *args):
        plans[name] = planned(rows)
        replace(self, name, rows, *args)

    monkeypatch.setattr(refresh, "stage", staging)
    monkeypatch.setattr(Transaction, "replace", replacing)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        refresh.refresh(ws, ("silver.order_items",))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plans["items"].count("Exchange hashpartitioning(id_item_pedido") == 1
    waiting = plans[refresh.WAITING]
    assert waiting.index("HashAggregate") < waiting.index("LeftAnti")
    assert waiting.rindex("HashAggregate") < waiting.index("LeftAnti")
    assert rows(store.read(refresh.WAITING), "id_item_pedido") == [("3",)]


def test_facts_by_order_are_built_without_a_shuffle(spark, tmp_path):
    orders = silver.silver_orders(bench.orders(spark, SMALL))
    items = silver.silver_order_items(bench.order_items(spark, SMALL), orders)
    database = f"t_{uuid.uuid4().hex[:8]}"
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        copartitioned.store_sales(orders, items, database, str(tmp_path), buckets=4)
        for built, expected in (
            (copartitioned.fact_sales(spark, database), facts.fact_sales(orders, items)),
            (copartitioned.fact_order_items(spark, database), facts.fact_order_items(items, orders)),
        ):
            plan = executed_plan(built)
            assert "Exchange" not in plan and "SortMergeJoin" in plan
            assert "Exchange" in executed_plan(expected)
            assert sorted(map(str, built.collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_buckets_follow_the_size():
    assert [copartitioned.buckets_for(n) for n in (0, 10**9, 10**12)] == [8, 8, 4096]


def test_units_of_any_span_from_the_days(spark):
    from tillflow.operators import marts

    sales = spark.range(5000).select(
        F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") % 90).cast("int")).alias("order_date"),
        F.when(F.col("id") % 50 != 0, F.col("id") * 7919 % 100_003).alias("unit_key"),
    )
    days = marts.units_by_day(sales)
    for span in (F.month("order_date"), F.lit(1), F.col("order_date")):
        expected = sales.groupBy(span.alias("span")).agg(F.count_distinct("unit_key").alias("active_units"))
        assert sorted(rows(marts.active_units(days, span))) == sorted(rows(expected))
    assert marts.active_units(days.limit(0), F.month("order_date")).count() == 0


def test_writes_leave_no_shuffle_files(spark, store, tmp_path):
    from tillflow import session

    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(blocks.size()) if (name := blocks.apply(i).getName()).startswith("shuffle_") and name.endswith(".data")}

    def gone(before):
        deadline = time.monotonic() + 20
        while files() - before and time.monotonic() < deadline:
            time.sleep(0.2)
        return not files() - before

    rows = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count(F.lit(1)).alias("n")).withColumn("order_month", F.col("k") % 3)
    before, setting = files(), spark.conf.get(session._CLEANUP, None)
    kept_by_plan = rows.hint("rebalance", "order_month")
    staged = session.stage(kept_by_plan)
    store.write("gold.some", kept_by_plan, "order_month", ("k",))
    assert gone(before)
    assert spark.conf.get(session._CLEANUP, None) == setting
    assert staged.count() == store.read("gold.some").count() == 700


def test_a_session_that_says_what_to_do_with_shuffles_keeps_its_setting(spark):
    from tillflow import session

    spark.conf.set(session._CLEANUP, "false")
    try:
        with session.shuffles_removed(spark):
            assert spark.conf.get(session._CLEANUP) == "false"
        assert spark.conf.get(session._CLEANUP) == "false"
    finally:
        spark.conf.unset(session._CLEANUP)
    with session.shuffles_removed(spark), session.shuffles_removed(spark):
        assert spark.conf.get(session._CLEANUP) == "true"
    assert spark.conf.get(session._CLEANUP, None) is None
