"""Times the layer builds and the headline queries; prints one JSON line.

Layers are built in order into a fresh folder (silver, gold, marts), then the queries run over the written
tables. BENCH_SF_DIR names the tables, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillflow.plans import pipeline, queries  # noqa: E402
from tillflow.plans.workspace import Workspace, bench_workspace  # noqa: E402
from tillflow.session import build_session, shared_dir  # noqa: E402
from tillflow.sources import bench as source  # noqa: E402
from tillflow.sources.tables import TableStore  # noqa: E402

# Queries over the marts and facts that the builds write, and operators over the source tables.
HEADLINES = (
    "exec_total_revenue",
    "exec_avg_order_value",
    "exec_revenue_trend",
    "exec_revenue_by_weekday",
    "units_ranking",
    "units_revenue_by_state",
    "prod_full_table",
    "prod_top_volume",
    "orders_delivery_fee_trend",
    "orders_value_histogram",
    "orders_revenue_by_channel",
    "orders_top_orders",
    "star_join_top10",
    "revenue_by_month",
    "item_breakdown",
    "dq_all",
    "detect_gaps",
    "retention_rows",
    "landing_orders",
    "landing_items",
    "validated_orders",
    "validation_report",
    "fact_sales",
    "fact_order_items",
    "metric_rate",
    "metric_sustained_breach",
    "stream_two_hour_rollup",
    "stream_late_items",
    "stream_sustained_breach",
    "fact_sales_by_order",
    "active_units_by_month",
)


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def drain(frame) -> None:
    """Run the whole query, every column of every row, without bringing the rows to the driver."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    partitions = cpus if cpus.isdigit() else "8"
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=partitions,
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    store = TableStore(spark, f"{shared_dir(spark)}/tillflow/bench-{uuid.uuid4().hex[:12]}")
    ws = Workspace(
        spark,
        lambda name: source.BRONZE_TABLES[name](spark, folder),
        store,
        as_of=source.REFERENCE_LOADED_AT,
    )
    times = {
        "build_silver": timed(lambda: pipeline.build_silver(ws)),
        "build_gold": timed(lambda: pipeline.build_gold(ws)),
        "build_marts": timed(lambda: pipeline.build_marts(ws)),
    }
    bench_workspace(spark, folder, ws)
    found = queries.registry()
    for name in HEADLINES:
        times[name] = timed(lambda name=name: drain(found[name](spark, folder)))
    total = round(sum(times.values()), 3)
    scale = os.path.basename(folder).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": scale, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
