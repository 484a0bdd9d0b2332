from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tillflow.functions.filters import MONTH_PARTITION, Filters
from tillflow.operators import maintenance, serving
from tillflow.plans import pipeline
from tillflow.plans.queries import COUNTED
from tillflow.plans.workspace import BUILDERS, Workspace
from tillflow.sources import bench
from tillflow.sources.tables import TableStore

DAY = date(2001, 7, 16)
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no benchmark tables")


def workspace(spark, root, bronze=None):
    bronze = bronze or (lambda name: bench.BRONZE_TABLES[name](spark, SMALL))
    return Workspace(spark, bronze, TableStore(spark, str(root)), as_of=bench.REFERENCE_LOADED_AT)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    ws = workspace(spark, tmp_path_factory.mktemp("lake"))
    pipeline.run_daily(ws, DAY, "run_1")
    return ws


def test_every_table_is_built(built):
    assert all(built.store.exists(name) for name in BUILDERS)
    counted = [name for name in COUNTED if not name.startswith("bronze.")]
    found = maintenance.table_counts({name: built.store.read(name) for name in counted})
    assert found.filter("row_count = 0").isEmpty()


def test_run_metrics_are_appended(built):
    found = built.store.read("monitoring.pipeline_metrics").filter("dag_run_id = 'run_1'")
    assert sorted(rows(found.select("metric_name"))) == [("duration",), ("pipeline_status",), ("rows_processed",)]
    assert rows(found.filter("metric_name = 'pipeline_status'"), "metric_value") == [(1.0,)]


def test_invariants(built):
    table = built.store.read
    orders, items, sales = table("silver.orders"), table("silver.order_items"), table("gold.fact_sales")
    assert orders.count() == orders.select("order_id").distinct().count() == sales.count()
    assert items.count() == items.select("order_item_id").distinct().count()
    assert items.join(orders, "order_id", "left_anti").isEmpty()
    total = sales.agg(F.sum("order_value")).first()[0]
    for mart in ("agg_daily_sales", "agg_unit_performance"):
        assert table(f"gold.{mart}").agg(F.sum("total_revenue")).first()[0] == total
        assert table(f"gold.{mart}").filter("cancellation_rate NOT BETWEEN 0 AND 100").isEmpty()
    for mart in ("agg_unit_performance", "agg_product_performance"):
        assert table(f"gold.{mart}").agg(F.min("revenue_rank")).first()[0] == 1
    sold = table("gold.agg_product_performance").agg(F.sum("total_revenue")).first()[0]
    assert sold == table("gold.fact_order_items").agg(F.sum("total_item_value")).first()[0]


def test_rebuilding_gives_the_same_rows(spark, built, tmp_path):
    again = workspace(spark, tmp_path)
    for _ in range(2):
        pipeline.build_silver(again)
        pipeline.build_gold(again)
        pipeline.build_marts(again)
    for name in BUILDERS:
        first, second = built.store.read(name), again.store.read(name)
        assert first.exceptAll(second.select(*first.columns)).isEmpty(), name
        assert first.count() == second.count(), name


def test_shuffled_input_gives_the_same_silver(spark, built, tmp_path):
    ws = workspace(spark, tmp_path, lambda name: bench.BRONZE_TABLES[name](spark, SMALL).orderBy(F.rand(7)))
    for name in ("silver.orders", "silver.order_items"):
        expected = built.store.read(name)
        assert expected.exceptAll(ws.table(name).select(*expected.columns)).isEmpty()


def test_an_empty_bronze_stops_the_run_and_is_reported(spark, tmp_path):
    ws = workspace(spark, tmp_path, lambda name: bench.BRONZE_TABLES[name](spark, SMALL).limit(0))
    with pytest.raises(pipeline.GateError, match="bronze.orders"):
        pipeline.run_daily(ws, DAY, "run_2")
    found = ws.store.read("monitoring.pipeline_metrics")
    assert rows(found.filter("metric_name = 'pipeline_status'"), "metric_value") == [(0.0,)]
    assert not ws.store.exists("silver.orders")


def test_orphan_units_stop_the_run(spark, tmp_path):
    def bronze(name):
        frame = bench.BRONZE_TABLES[name](spark, SMALL)
        return frame.filter("id_unidade <> 1") if name == "bronze.units" else frame

    with pytest.raises(pipeline.GateError, match="no_orphan_units"):
        pipeline.run_daily(workspace(spark, tmp_path, bronze), DAY)


def test_quality_run_is_logged_once(built):
    failed = pipeline.run_quality(built, DAY, "run_3", expected_units=1)
    log = built.store.read("monitoring.data_quality_log")
    assert log.count() == 6
    assert sorted(rows(failed, "check_name")) == sorted(rows(log.filter("result = 'fail'"), "check_name"))
    event = built.store.read("monitoring.pipeline_metrics").filter("metric_name = 'quality_failure'")
    assert rows(event, "metric_value") == [(float(failed.count()),)]


def test_retention_run(spark, tmp_path):
    ws = workspace(spark, tmp_path)
    for name in ("bronze.orders", "bronze.order_items"):
        ws.store.write(name, ws.table(name).filter("_ingest_date >= '2001-01-01'"), "_ingest_date")
    before = {t: (e, k) for t, e, k in rows(pipeline.run_retention(ws, date(2001, 8, 2)))}
    after = {n: ws.store.read(n).count() for n in before}
    assert after == {name: kept for name, (_, kept) in before.items()}
    assert all(expired > 0 for expired, _ in before.values())


def test_usage_report_is_appended(spark, built, tmp_path):
    (tmp_path / "a.csv").write_text("x" * 2048)
    over = pipeline.run_usage_report(built, str(tmp_path), datetime(2026, 2, 1, 4), {"objects": 1e-6, "warehouse": 1.0})
    assert rows(over, "store", "storage_bytes") == [("objects", 2048)]
    saved = built.store.read("monitoring.free_tier_usage")
    assert rows(saved, "gcs_storage_bytes", F.col("bq_storage_bytes") > 0, "details") == [(2048, True, '{"source":"data_retention"}')]


def test_file_retention_run(spark, built, tmp_path):
    for name, age in (("old.csv", 70), ("new.csv", 5)):
        (tmp_path / name).write_text("x")
        stamp = datetime.now().timestamp() - age * 86400
        os.utime(tmp_path / name, (stamp, stamp))
    for dry_run, left in ((True, 2), (False, 1)):
        found = pipeline.run_file_retention(built, str(tmp_path), datetime.now(), dry_run=dry_run)
        assert rows(found, "deleted_count", "skipped_count") == [(1, 1)]
        assert len(os.listdir(tmp_path)) == left


def test_reference_refresh(spark, tmp_path):
    from test_maintenance import source_tables

    from tillflow.sources.reference import extract_reference

    extract_reference(spark, source_tables(spark), str(tmp_path / "files"))
    ws = workspace(spark, tmp_path / "lake")
    checks = dict(rows(pipeline.run_reference_refresh(ws, str(tmp_path / "files")), "check_name", "status"))
    assert checks["countries_row_count"] == "OK"
    assert checks["products_row_count"] == "WARN"
    assert checks["orphan_units"] == "OK"


def test_backfill_check(built):
    found = pipeline.run_backfill_check(built, date(2001, 8, 2))
    assert found.count() > 0
    assert found.filter("NOT still_missing").isEmpty()


def test_facts_are_laid_out_by_month_and_day(built):
    sales = built.store.read("gold.fact_sales")
    assert MONTH_PARTITION in sales.columns
    one_month = Filters(date(1997, 3, 1), date(1997, 3, 9))
    trend = serving.orders_delivery_fee_trend(sales, one_month)
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_ym" in plan
    assert "1997-03" in plan
    assert "GreaterThanOrEqual(order_date,1997-03-01)" in plan
    assert trend.count() == sales.filter("order_date between '1997-03-01' and '1997-03-09'").select("order_date").distinct().count()


def test_built_tables_can_be_queried_by_name(spark, built):
    names = pipeline.publish_catalog(built, "shop_")
    assert len(names) == len(BUILDERS)
    orders = built.store.read("gold.fact_sales").count()
    assert spark.sql("SELECT count(*) FROM shop_gold.fact_sales").first()[0] == orders
    assert spark.sql("SELECT sum(total_orders) FROM shop_gold.agg_daily_sales").first()[0] == orders
    weekday = spark.sql(
        "SELECT day_of_week_name, sum(total_orders) AS total_orders FROM shop_gold.agg_daily_sales GROUP BY day_of_week_name"
    )
    shown = serving.exec_revenue_by_weekday(built.store.read("gold.agg_daily_sales"))
    assert sorted(rows(weekday)) == sorted(rows(shown, "day_of_week_name", "total_orders"))


def test_as_of_is_the_only_clock(built):
    found = built.store.read("gold.dim_unit").agg(F.min("_valid_from"), F.max("_valid_from"))
    assert rows(found) == [(datetime(2002, 1, 1), datetime(2002, 1, 1))]
