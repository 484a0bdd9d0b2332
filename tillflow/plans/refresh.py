"""Incremental refresh: from the loads that are new in bronze to the orders they touch, and from those to the months to replace.

The log of the store tells which loads came in since the last refresh. Their orders, the orders of their items and those
whose waiting items can be taken now are touched; a month is touched if a touched order is in it, before or after. All
rows of a touched month are then put together from the rows that the months hold of other orders, in every layer as they
were, and from those of the touched orders, built anew. Silver, facts and daily sales of those months are replaced in one commit,
which also marks the loads as done. The result is that of a full rebuild, which stays the way to begin.

A store can keep a part of the tables: those named and those below them. Nothing is read or built for the others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.filters import MONTH_PARTITION
from tillflow.operators import dimensions, facts, marts, silver
from tillflow.plans.workspace import BUILDERS, MARTS, MONTHLY_LAYOUT, Workspace, with_month
from tillflow.session import stage
from tillflow.sources.tables import NULL_PARTITION

JOB = "refresh"
WAITING = "silver.items_waiting"
MONTHLY = ("silver.orders", "silver.order_items", "gold.fact_sales", "gold.fact_order_items", "gold.agg_daily_sales")


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: everything anew, or the months that were replaced."""

    rebuilt: bool
    months: tuple[str, ...]


def _month(of: Column | str = MONTH_PARTITION) -> Column:
    return F.coalesce(F.col(of) if isinstance(of, str) else of, F.lit(NULL_PARTITION))


def _values(rows: DataFrame, column: Column) -> list:
    """The distinct values of a column of days or months, of which there are few."""
    return sorted(row[0] for row in rows.select(column).distinct().collect() if row[0] is not None)


#: What a table of months is built from, besides bronze.
BELOW = {
    "silver.order_items": ("silver.orders",),
    "gold.dim_date": ("silver.orders",),
    "gold.fact_sales": ("silver.order_items",),
    "gold.fact_order_items": ("silver.order_items",),
    "gold.agg_daily_sales": ("gold.dim_date", "gold.fact_sales"),
}


def kept(names: tuple[str, ...] | None) -> tuple[str, ...]:
    """Tables of months with those below them, in the order in which they are built; all tables without names."""
    if names is None:
        return tuple(BUILDERS)
    if unknown := set(names) - set(MONTHLY):
        raise ValueError(f"not tables of months: {sorted(unknown)}")
    found, todo = set(), list(names)
    while todo:
        found.add(name := todo.pop())
        todo += BELOW.get(name, ())
    return tuple(name for name in BUILDERS if name in found)


def _job(tables: tuple[str, ...]) -> str:
    return JOB if tables == tuple(BUILDERS) else f"{JOB} of {', '.join(tables)}"


def _since(state: dict, tables: tuple[str, ...]) -> int:
    """The version up to which loads are done; -1 if the tables are not there, or a refresh of other tables was the last one."""
    done = {name: number for name, number in state["batches"].items() if name == JOB or name.startswith(f"{JOB} of ")}
    since = done.get(_job(tables), -1)
    wanted = [name for name in MONTHLY if name in tables]
    ready = all(name in state["tables"] and state["tables"][name]["partition"] == MONTH_PARTITION for name in wanted)
    ready = ready and ("silver.order_items" not in tables or WAITING in state["tables"])
    return since if ready and since == max(done.values(), default=-1) else -1


def rebuild(ws: Workspace, keep: tuple[str, ...] | None = None) -> Refreshed:
    """All layers from all of bronze, in the layout that a refresh needs. Marked as done at the end only."""
    store, upto, tables = ws.store, ws.store.state()[0], kept(keep)
    ws.layout = MONTHLY_LAYOUT
    for name in tables:
        ws.build(name)
    with store.transaction((_job(tables), upto)) as changes:
        if "silver.order_items" in tables:
            # The ids alone are compared with all orders; the lost ones are few beside the items.
            known = store.read("silver.orders").select(F.col("order_id").alias("id_pedido"))
            items = ws.table("bronze.order_items")
            lost = stage(items.select("id_pedido").distinct().join(known, "id_pedido", "left_anti"))
            waits = items.join(lost, items["id_pedido"].eqNullSafe(lost["id_pedido"]), "left_semi")
            changes.replace(WAITING, waits.select("id_pedido", *[n for n in waits.columns if n != "id_pedido"]))
    return Refreshed(True, ())


def refresh(ws: Workspace, keep: tuple[str, ...] | None = None) -> Refreshed:
    """Bring silver, gold and marts up to date with bronze, which the workspace reads from its store.

    ``keep`` names the tables of months that the store keeps, all tables without it; it is rebuilt when they change. Rows that
    were taken out of bronze by retention stay in silver and gold, unlike in a full rebuild. Unit and product marts
    rank over all history and are built anew from the facts.
    """
    store, tables = ws.store, kept(keep)
    upto, state = store.state()
    since = _since(state, tables)
    if since < 0:
        return rebuild(ws, keep)
    ws.layout = MONTHLY_LAYOUT
    has_items = "silver.order_items" in tables
    new_orders = store.read_since("bronze.orders", since)
    new_items = store.read_since("bronze.order_items", since) if has_items else None
    if new_orders.isEmpty() and (not has_items or new_items.isEmpty()):
        return Refreshed(False, ())
    old_orders = store.read("silver.orders")
    new_ids = stage(new_orders.select(F.col("id_pedido").alias("order_id")).filter("order_id IS NOT NULL").distinct())
    touched = new_ids
    if has_items:
        # Items that may change: the new ones, and those that waited for an order that is here now.
        old_items, waiting = store.read("silver.order_items"), store.read(WAITING)
        released = waiting.join(new_ids, waiting["id_pedido"] == new_ids["order_id"], "left_semi")
        fresh_items = stage(new_items.unionByName(released))
        item_ids = stage(fresh_items.select(F.col("id_item_pedido").alias("order_item_id")).distinct())
        replaced_items = stage(
            old_items.select("order_item_id", "order_id", "_ingest_date").join(item_ids, "order_item_id", "left_semi").drop("order_item_id")
        )
        touched = new_ids.union(fresh_items.select(F.col("id_pedido").alias("order_id"))).union(replaced_items.select("order_id"))
        touched = stage(touched.filter("order_id IS NOT NULL").distinct())
    before = stage(old_orders.join(touched, "order_id", "left_semi"))

    # A touched order's newest delivery is among the new rows or in the load that its row in silver came with.
    days = _values(before.select("_ingest_date").union(new_orders.select("_ingest_date")), F.col("_ingest_date"))
    delivered = store.read("bronze.orders").filter(F.col("_ingest_date").isin(days))
    built = silver.silver_orders(delivered.join(new_ids, delivered["id_pedido"] == new_ids["order_id"], "left_semi"))
    unchanged = before.join(new_ids, "order_id", "left_anti").select(*built.columns)
    orders_now = stage(with_month(built.unionByName(unchanged)))
    months = sorted({*_values(before, _month()), *_values(orders_now, _month())})

    def others(name: str) -> DataFrame:
        """What the months hold of orders that are not touched; it stays as it is."""
        return store.read(name).filter(_month().isin(months)).join(touched, "order_id", "left_anti")

    with store.transaction((_job(tables), upto)) as changes:

        def replace(name: str, rows: DataFrame) -> None:
            if name in tables:
                changes.replace_partitions(name, rows, MONTH_PARTITION, months, MONTHLY_LAYOUT[name][1])

        replace("silver.orders", others("silver.orders").unionByName(orders_now))
        if has_items:
            days = _values(replaced_items.select("_ingest_date").union(fresh_items.select("_ingest_date")), F.col("_ingest_date"))
            sent = store.read("bronze.order_items").filter(F.col("_ingest_date").isin(days)).unionByName(released)
            # The deliveries that can win have touched orders; of those all that are known are in ``orders_now``. The items that
            # may change are picked last, where the newest of each id lie together already.
            known = orders_now.select("order_id", MONTH_PARTITION)
            built_items = silver.silver_order_items(sent, known, MONTH_PARTITION).join(item_ids, "order_item_id", "left_semi")
            # What stays is written by itself, so that its shuffles are gone before those of the new items begin.
            stay = old_items.filter(_month().isin(months)).drop(MONTH_PARTITION).join(known, "order_id").join(item_ids, "order_item_id", "left_anti")
            items_now = stage(stage(stay).unionByName(built_items).select(*built_items.columns))
            replace("silver.order_items", others("silver.order_items").unionByName(items_now))
            if "gold.fact_sales" in tables:
                replace("gold.fact_sales", others("gold.fact_sales").unionByName(with_month(facts.fact_sales(orders_now, items_now))))
            if "gold.fact_order_items" in tables:
                replace("gold.fact_order_items", others("gold.fact_order_items").unionByName(with_month(facts.fact_order_items(items_now, orders_now))))
            if "gold.agg_daily_sales" in tables:
                days_now = dimensions.dim_date_of(changes.rows("silver.orders"))
                replace("gold.agg_daily_sales", with_month(marts.agg_daily_sales(days_now, changes.rows("gold.fact_sales"), orders_unique=True)))
            ids = known.select(F.col("order_id").alias("id_pedido"))
            still_waiting = waiting.unionByName(new_items).join(ids, "id_pedido", "left_anti").distinct()
            changes.replace(WAITING, still_waiting.select(*waiting.columns))
    ws.forget(*[name for name in MONTHLY if name in tables])
    for name in ("gold.dim_date", *[mart for mart in MARTS if mart not in MONTHLY]):
        if name in tables:
            ws.build(name)
    return Refreshed(False, tuple(months))
