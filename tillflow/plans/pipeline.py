"""The daily run: layers in order, gates between them, metrics at the end."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators import maintenance, quality, run_metrics
from tillflow.plans.workspace import BUILDERS, DIMENSIONS, FACTS, MARTS, SILVER_REFERENCE, SILVER_SALES, Workspace
from tillflow.schemas import REFERENCE_SPECS
from tillflow.sources.inventory import Inventory
from tillflow.sources.landing import file_inventory
from tillflow.sources.reference import load_reference

DAG_ID = "daily_pipeline"


class GateError(ValueError):
    """A layer did not pass its checks."""


def build_silver(ws: Workspace) -> None:
    """Reference tables beside the sales tables; items after orders, which they are checked against."""
    _together(ws, [SILVER_REFERENCE, SILVER_SALES])


def build_gold(ws: Workspace) -> None:
    """Dimensions and each fact are independent of each other."""
    _together(ws, [DIMENSIONS, *[(fact,) for fact in FACTS]])


def build_marts(ws: Workspace) -> None:
    _together(ws, [(mart,) for mart in MARTS])


def _together(ws: Workspace, chains: list[tuple[str, ...]]) -> None:
    """Build each chain in order and the chains at the same time; Spark shares the executors among the jobs."""

    def build(chain: tuple[str, ...]) -> None:
        for name in chain:
            ws.build(name)

    with ThreadPoolExecutor(len(chains)) as pool:
        target = inheritable_thread_target(ws.spark)(build)
        for done in [pool.submit(target, chain) for chain in chains]:
            done.result()


def require(gates: DataFrame, layer: str) -> None:
    """Raise when a gate did not pass. Gates are a handful of rows."""
    failed = [row[0] for row in gates.filter(~F.col("passed")).collect()]
    if failed:
        raise GateError(f"{layer} check failed: {', '.join(failed)}")


def run_daily(ws: Workspace, day: date, run_id: str = "") -> DataFrame:
    """Rebuild silver, gold and marts, each behind its gate; the run's metrics are appended even when it fails."""
    started, succeeded = time.monotonic(), False
    try:
        if ws.table("bronze.orders").isEmpty():
            raise GateError("bronze check failed: bronze.orders has no rows")
        build_silver(ws)
        require(quality.silver_gate(ws.store.read("silver.orders"), ws.store.read("silver.order_items")), "silver")
        build_gold(ws)
        build_marts(ws)
        gold = [ws.store.read(f"gold.{name}") for name in ("fact_sales", "dim_product", "dim_unit")]
        require(quality.gold_gate(*gold), "gold")
        require(quality.day_gate(gold[0], ws.store.read("gold.dim_date")), "gold")
        succeeded = True
    finally:
        counted = {
            name: ws.store.read(name)
            for name in ("silver.orders", "gold.fact_sales", "gold.agg_daily_sales")
            if ws.store.exists(name)
        }
        if not counted:
            counted = {"bronze.orders": ws.table("bronze.orders").limit(0)}
        seconds = time.monotonic() - started
        summary = run_metrics.run_summary(
            maintenance.table_counts(counted), DAG_ID, day, seconds, run_id, succeeded, ws.as_of
        )
        ws.store.append("monitoring.pipeline_metrics", summary, "execution_date")
    return ws.store.read("monitoring.pipeline_metrics")


def run_quality(ws: Workspace, day: date, run_id: str = "", **thresholds) -> DataFrame:
    """Run the six checks once, append them to the log, and return the rows of this run that failed."""
    checks = quality.standard_checks(
        ws.table("silver.order_items"),
        ws.table("gold.fact_sales"),
        ws.table("gold.fact_order_items"),
        ws.table("gold.dim_product"),
        day,
        **thresholds,
    )
    results = quality.run_checks(ws.spark, checks)
    ws.store.append("monitoring.data_quality_log", quality.log_rows(results, day, run_id, ws.as_of), "execution_date")
    failed = quality.failures(results)
    if not failed.isEmpty():
        event = run_metrics.quality_failure(failed, "data_quality", day, run_id, ws.as_of)
        ws.store.append("monitoring.pipeline_metrics", event, "execution_date")
    return failed


def publish_catalog(ws: Workspace, prefix: str = "") -> list[str]:
    """Make the built tables known to the catalog as ``layer.table``, so that SQL can name them."""
    built = [name for name in BUILDERS if ws.store.exists(name)]
    for name in built:
        ws.store.register(prefix + name.split(".")[0], name)
    return [prefix + name for name in built]


def run_reference_refresh(ws: Workspace, folder: str) -> DataFrame:
    """Replace the bronze reference tables from their files; returns the checks on the new tables."""
    load_reference(ws.spark, folder, ws.store, ws.as_of)
    return quality.reference_checks({spec.table: ws.store.read(f"bronze.{spec.table}") for spec in REFERENCE_SPECS})


def run_retention(ws: Workspace, as_of: date, max_days: int = maintenance.BRONZE_MAX_DAYS) -> DataFrame:
    """Count the old bronze rows, then drop their day partitions; returns the counts as they were before."""
    names = ("bronze.orders", "bronze.order_items")
    tables = {name: ws.store.read(name) for name in names}
    counts = maintenance.retention_rows(tables, as_of, max_days).collect()
    cutoff = maintenance.retention_cutoff(as_of, max_days)
    for name in names:
        ws.store.drop_partitions_before(name, "_ingest_date", cutoff)
    return ws.spark.createDataFrame(counts, "table_name string, expired_rows long, kept_rows long")


def run_file_retention(
    ws: Workspace,
    path: str,
    as_of: datetime,
    max_days: int = maintenance.RAW_FILE_MAX_DAYS,
    dry_run: bool = False,
    inventory: Inventory | None = None,
) -> DataFrame:
    """Delete landing files that are too old, unless ``dry_run``; returns what was found before.

    With an ``inventory`` of ``path`` only folders that changed are listed, before and after.
    """
    if inventory:
        inventory.refresh()
    files = inventory.files() if inventory else file_inventory(ws.spark, path)
    found = maintenance.retention_files(files, as_of, max_days, dry_run).collect()
    if not dry_run:
        old = maintenance.expired_files(files, as_of, max_days)
        if any(sign in path for sign in "*?[{"):
            ws.store.delete_files(old)
        else:
            ws.store.delete_expired(files, old, path)
        if inventory:
            inventory.refresh()
    return ws.spark.createDataFrame(
        found, "deleted_count long, deleted_bytes long, skipped_count long, dry_run boolean"
    )


def run_usage_report(
    ws: Workspace, landing: str, as_of: datetime, limits_gb: dict[str, float] | None = None, inventory: Inventory | None = None
) -> DataFrame:
    """Append a snapshot of the sizes of landing files and tables; returns the stores above the alert level."""
    if inventory:
        inventory.refresh()
    objects = (inventory.files() if inventory else file_inventory(ws.spark, landing)).select(F.lit("objects").alias("store"), "length")
    tables = file_inventory(ws.spark, ws.store.root).select(F.lit("warehouse").alias("store"), "length")
    usage = maintenance.storage_usage(objects.unionByName(tables), limits_gb)
    ws.store.append("monitoring.free_tier_usage", maintenance.usage_snapshot(usage, as_of), "snapshot_date")
    return maintenance.usage_alert(usage)


def run_backfill_check(ws: Workspace, as_of: date, days: int = 30) -> DataFrame:
    """The gaps of the last days, each with whether bronze has rows for it by now."""
    gaps = maintenance.detect_gaps(ws.table("gold.fact_sales"), as_of, days)
    first, last = as_of - timedelta(days=days), as_of - timedelta(days=1)
    missing = maintenance.validate_backfill(gaps, ws.table("bronze.orders"), days, first, last)
    return gaps.join(missing.withColumn("still_missing", F.lit(True)), "missing_date", "left").select(
        "missing_date", F.coalesce("still_missing", F.lit(False)).alias("still_missing")
    )
