"""The table graph: which operator builds each table, from which tables, in which layout."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tillflow.functions.dates import year_month
from tillflow.functions.filters import MONTH_PARTITION
from tillflow.operators import dimensions, facts, marts, silver
from tillflow.session import shared_dir, spread_shuffles
from tillflow.sources import bench
from tillflow.sources.tables import TableStore

Bronze = Callable[[str], DataFrame]


class Workspace:
    """Bronze tables, and the tables built from them in a store.

    The date dimension spans the years of the orders unless a first and a last day are given.

    ``compose`` gives the frame of an operator over the tables it reads; ``table`` gives the written table and
    writes it, and what it needs, on first use. A table is written once per workspace, so that every query
    on a mart does not rebuild the layers below it.
    """

    def __init__(
        self,
        spark: SparkSession,
        bronze: Bronze,
        store: TableStore,
        first_day: date | None = None,
        last_day: date | None = None,
        as_of: datetime | None = None,
        layout: dict[str, tuple[str | None, tuple[str, ...]]] | None = None,
    ) -> None:
        spread_shuffles(spark)
        self.spark = spark
        self.layout = LAYOUT if layout is None else layout
        self.store = store
        self.first_day, self.last_day = first_day, last_day
        self.as_of = as_of
        self._bronze = bronze
        self._tables: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def compose(self, name: str) -> DataFrame:
        return BUILDERS[name](self)

    def table(self, name: str) -> DataFrame:
        if name.startswith("bronze."):
            return self._bronze(name)
        with self._lock:
            if name not in self._tables:
                self.build(name)
            return self._tables[name]

    def view(self, name: str) -> DataFrame:
        """The table if it is written already, else the frame that would be written.

        For a single reader of few columns: the other columns are then not shuffled, sorted and written for it.
        """
        with self._lock:
            return self._tables[name] if name in self._tables else self.compose(name)

    def forget(self, *names: str) -> None:
        """Read these tables from the store again when they are asked for next."""
        with self._lock:
            for name in names:
                self._tables[name] = self.store.read(name)

    def build(self, name: str) -> None:
        """Write the table anew."""
        partition, cluster = self.layout.get(name, (None, ()))
        rows = self.compose(name)
        if partition == MONTH_PARTITION and MONTH_PARTITION not in rows.columns:
            rows = with_month(rows)
        self.store.write(name, rows, partition, cluster)
        self._tables[name] = self.store.read(name)


def with_month(rows: DataFrame) -> DataFrame:
    """Rows with the month of their order."""
    return rows.withColumn(MONTH_PARTITION, year_month(rows["order_date"]))


def _silver_items(w: Workspace) -> DataFrame:
    """By months the items take the month of their order from the join with the orders, which is there anyway."""
    monthly = w.layout.get("silver.order_items", (None, ()))[0] == MONTH_PARTITION
    orders = w.table("silver.orders")
    if not monthly:
        return silver.silver_order_items(w.table("bronze.order_items"), orders)
    return silver.silver_order_items(w.table("bronze.order_items"), with_month(orders), MONTH_PARTITION)


# A month is the partition of the facts, not a day: years of days would make thousands of small folders. The
# day leads the sort, so row groups still cover few days.
LAYOUT: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "gold.fact_sales": (MONTH_PARTITION, ("order_date", "unit_key", "order_type")),
    "gold.fact_order_items": (MONTH_PARTITION, ("order_date", "product_key")),
}

# With months below the facts and above them, so that a refresh replaces what belongs to a month in every layer.
MONTHLY_LAYOUT = LAYOUT | {
    "silver.orders": (MONTH_PARTITION, ("order_id",)),
    "silver.order_items": (MONTH_PARTITION, ("order_id",)),
    "gold.agg_daily_sales": (MONTH_PARTITION, ("order_date",)),
}

BUILDERS: dict[str, Callable[[Workspace], DataFrame]] = {
    "silver.products": lambda w: silver.silver_products(w.table("bronze.products"), w.as_of),
    "silver.states": lambda w: silver.silver_states(w.table("bronze.states"), w.as_of),
    "silver.countries": lambda w: silver.silver_countries(w.table("bronze.countries"), w.as_of),
    "silver.units": lambda w: silver.silver_units(
        w.table("bronze.units"), w.table("bronze.states"), w.table("bronze.countries"), w.as_of
    ),
    "silver.orders": lambda w: silver.silver_orders(w.table("bronze.orders")),
    "silver.order_items": _silver_items,
    "gold.dim_date": lambda w: (
        dimensions.dim_date(w.spark, w.first_day, w.last_day)
        if w.first_day and w.last_day
        else dimensions.dim_date_of(w.table("silver.orders"))
    ),
    "gold.dim_product": lambda w: dimensions.dim_product(w.table("silver.products"), w.as_of),
    "gold.dim_unit": lambda w: dimensions.dim_unit(w.table("silver.units"), w.as_of),
    "gold.dim_geography": lambda w: dimensions.dim_geography(w.table("silver.states"), w.table("silver.countries")),
    "gold.fact_sales": lambda w: facts.fact_sales(w.table("silver.orders"), w.table("silver.order_items")),
    "gold.fact_order_items": lambda w: facts.fact_order_items(w.table("silver.order_items"), w.table("silver.orders")),
    "gold.agg_daily_sales": lambda w: marts.agg_daily_sales(
        w.table("gold.dim_date"), w.table("gold.fact_sales"), orders_unique=True
    ),
    "gold.agg_unit_performance": lambda w: marts.agg_unit_performance(
        w.table("gold.dim_unit"), w.table("gold.fact_sales"), orders_unique=True
    ),
    "gold.agg_product_performance": lambda w: marts.agg_product_performance(
        w.table("gold.dim_product"), w.table("gold.fact_order_items"), w.table("gold.dim_unit")
    ),
}

SILVER_REFERENCE = ("silver.products", "silver.states", "silver.countries", "silver.units")
SILVER_SALES = ("silver.orders", "silver.order_items")
DIMENSIONS = ("gold.dim_date", "gold.dim_product", "gold.dim_unit", "gold.dim_geography")
FACTS = ("gold.fact_sales", "gold.fact_order_items")
MARTS = ("gold.agg_daily_sales", "gold.agg_unit_performance", "gold.agg_product_performance")

_workspaces: dict[tuple[str, str], Workspace] = {}


def bench_workspace(spark: SparkSession, folder: str, ready: Workspace | None = None) -> Workspace:
    """The workspace over a folder of benchmark tables; one per application and folder, or the one given.

    Its tables go to the shared folder under the application's id, so they never outlive their input.
    """
    key = (spark.sparkContext.applicationId, folder)
    if ready is not None:
        _workspaces[key] = ready
    if key not in _workspaces:
        tag = hashlib.sha256(folder.encode()).hexdigest()[:12]
        store = TableStore(spark, f"{shared_dir(spark)}/tillflow/{key[0]}/{tag}")
        _workspaces[key] = Workspace(
            spark,
            lambda name: bench.BRONZE_TABLES[name](spark, folder),
            store,
            as_of=bench.REFERENCE_LOADED_AT,
        )
    return _workspaces[key]
