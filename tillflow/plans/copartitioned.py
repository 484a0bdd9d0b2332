"""Silver sales stored by order id, so that facts are built without a shuffle.

Orders and items are catalog tables with the same buckets of the order id, one sorted file for each bucket. Whatever joins or
groups by order id then starts from the files: Spark plans neither an exchange nor a sort. It pays where the facts are built
more often than silver. An order that holds a large share of the items fills its bucket, which, unlike a shuffle partition,
cannot be split at run time; plain tables stay the default for that reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillflow.operators import facts

BY = "order_id"
#: Bytes of Parquet that a bucket should hold at most, on average.
BUCKET_BYTES = 256 * 1024 * 1024


def buckets_for(total_bytes: int, least: int = 8) -> int:
    """The number of buckets for tables of a size: a power of two, so that it changes seldom as the tables grow."""
    wanted = max(least, -(-total_bytes // BUCKET_BYTES))
    return 1 << (wanted - 1).bit_length()


def store_by_order(rows: DataFrame, table: str, folder: str, buckets: int) -> None:
    """Replace the catalog table ``table`` by ``rows``, in ``buckets`` files by order id below ``folder``."""
    database = table.rpartition(".")[0]
    if database:
        rows.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    by_bucket = rows.repartition(buckets, BY)
    by_bucket.write.bucketBy(buckets, BY).sortBy(BY).option("path", folder).mode("overwrite").format("parquet").saveAsTable(table)


def store_sales(orders: DataFrame, items: DataFrame, database: str, folder: str, buckets: int) -> None:
    """Silver orders and items as ``database.orders`` and ``database.order_items``."""
    for rows, name in ((orders, "orders"), (items, "order_items")):
        store_by_order(rows, f"{database}.{name}", f"{folder}/{name}", buckets)


def fact_sales(spark: SparkSession, database: str) -> DataFrame:
    return facts.fact_sales(spark.table(f"{database}.orders"), spark.table(f"{database}.order_items"))


def fact_order_items(spark: SparkSession, database: str) -> DataFrame:
    return facts.fact_order_items(spark.table(f"{database}.order_items"), spark.table(f"{database}.orders"))
