"""Gap detection, retention, storage and query usage, row counts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.dates import days_between
from tillflow.functions.filters import Filters

BRONZE_MAX_DAYS = 90
RAW_FILE_MAX_DAYS = 60
USAGE_ALERT_PCT = 80
MAX_AGE_HOURS = 48
STORAGE_ALERT_GB = 8
QUERY_ALERT_GB = 800
PRICE_PER_TB = 5.0
GIB = 1024**3
# Gigabytes that each store may hold, terabytes that queries may read in a month.
STORE_LIMITS_GB = {"objects": 5.0, "warehouse": 10.0}
QUERY_LIMIT_TB = 1.0


# --- gaps ---


def detect_gaps(sales: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Days of the ``days`` before ``as_of`` without an order, oldest first."""
    first, last = as_of - timedelta(days=days), as_of - timedelta(days=1)
    seen = Filters(first, last).dates(sales).select("order_date").distinct()
    wanted = days_between(sales.sparkSession, first, last, "missing_date")
    gaps = wanted.join(seen, F.col("missing_date") == F.col("order_date"), "left_anti")
    return gaps.orderBy("missing_date")


def validate_backfill(
    gaps: DataFrame, bronze_orders: DataFrame, limit: int = 7, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Of the first ``limit`` gaps, the days that bronze still has no rows for.

    ``first`` and ``last`` bound the gaps; they reach the scan as literals. Bronze rows of other days than the few
    that are checked are dropped before the shuffle.
    """
    checked = gaps.orderBy("missing_date").limit(limit)
    landed = bronze_orders.select(F.col("data_pedido").alias("missing_date"))
    if first is not None and last is not None:
        landed = landed.filter(F.col("missing_date").between(F.lit(first), F.lit(last)))
    landed = landed.join(F.broadcast(checked), "missing_date", "left_semi").distinct()
    return checked.join(landed, "missing_date", "left_anti").orderBy("missing_date")


# --- retention ---


def retention_cutoff(as_of: date, max_days: int) -> date:
    return as_of - timedelta(days=max_days)


def retention_rows(tables: dict[str, DataFrame], as_of: date, max_days: int = BRONZE_MAX_DAYS) -> DataFrame:
    """Kept and expired rows per bronze table, by ingest day."""
    expired = F.col("_ingest_date") < F.lit(retention_cutoff(as_of, max_days))
    result = None
    for name, rows in tables.items():
        counted = rows.agg(
            F.count_if(expired).alias("expired_rows"), F.count_if(~F.coalesce(expired, F.lit(False))).alias("kept_rows")
        ).select(F.lit(name).alias("table_name"), "expired_rows", "kept_rows")
        result = counted if result is None else result.unionByName(counted)
    return result


def retained(rows: DataFrame, as_of: date, max_days: int = BRONZE_MAX_DAYS) -> DataFrame:
    """The rows that stay; a row without an ingest day is never old."""
    cutoff = F.lit(retention_cutoff(as_of, max_days))
    return rows.filter(F.col("_ingest_date").isNull() | (F.col("_ingest_date") >= cutoff))


def _file_expired(as_of, max_days: int) -> Column:
    age_limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(max_days))
    return F.coalesce(F.col("modificationTime") < age_limit, F.lit(False))


def expired_files(files: DataFrame, as_of, max_days: int = RAW_FILE_MAX_DAYS) -> DataFrame:
    return files.filter(_file_expired(as_of, max_days))


def retention_files(files: DataFrame, as_of, max_days: int = RAW_FILE_MAX_DAYS, dry_run: bool = True) -> DataFrame:
    """Number and bytes of the files that are (or with ``dry_run`` would be) deleted, and how many stay."""
    old = _file_expired(as_of, max_days)
    return files.agg(
        F.count_if(old).alias("deleted_count"),
        F.coalesce(F.sum(F.when(old, F.col("length"))), F.lit(0)).alias("deleted_bytes"),
        F.count_if(~old).alias("skipped_count"),
    ).withColumn("dry_run", F.lit(dry_run))


# --- storage ---


def storage_usage(files: DataFrame, limits_gb: dict[str, float] | None = None) -> DataFrame:
    """Bytes, gigabytes and share of the limit per store. ``files`` has ``store`` and ``length``."""
    limits_gb = STORE_LIMITS_GB if limits_gb is None else limits_gb
    limit = F.coalesce(*[F.when(F.col("store") == name, F.lit(float(gb))) for name, gb in limits_gb.items()])
    return (
        files.groupBy("store")
        .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("storage_bytes"))
        .select(
            "store",
            "storage_bytes",
            F.round(F.col("storage_bytes") / GIB, 3).alias("storage_gb"),
            limit.alias("limit_gb"),
            F.round(F.col("storage_bytes") / GIB / limit * 100, 1).alias("usage_pct"),
        )
    )


def usage_alert(usage: DataFrame, alert_pct: float = USAGE_ALERT_PCT) -> DataFrame:
    """Stores whose share of the limit is above the alert level."""
    return usage.filter(F.col("usage_pct") > alert_pct)


def storage_alert(files: DataFrame, limit_gb: float = STORAGE_ALERT_GB) -> DataFrame:
    """Total size of the files and whether it is above the limit."""
    size = F.round(F.coalesce(F.sum("length"), F.lit(0)) / F.pow(F.lit(1024.0), F.lit(3)), 2)
    return files.agg(size.alias("storage_gb")).withColumn("alert", F.col("storage_gb") > limit_gb)


def usage_snapshot(usage: DataFrame, as_of, source: str = "data_retention") -> DataFrame:
    """One row of the usage table out of the per-store frame. Query volume is not measured here: zeros."""
    now = F.lit(as_of).cast("timestamp")

    def of(store: str, column: str) -> Column:
        return F.max(F.when(F.col("store") == store, F.col(column)))

    # The column names
    pivoted = usage.agg(
        of("objects", "storage_bytes").alias("gcs_storage_bytes"),
        of("objects", "storage_gb").alias("gcs_storage_gb"),
        of("objects", "limit_gb").alias("gcs_limit_gb"),
        of("objects", "usage_pct").alias("gcs_usage_pct"),
        of("warehouse", "storage_bytes").alias("bq_storage_bytes"),
        of("warehouse", "storage_gb").alias("bq_storage_gb"),
        of("warehouse", "limit_gb").alias("bq_limit_gb"),
        of("warehouse", "usage_pct").alias("bq_usage_pct"),
    )
    return pivoted.select(
        F.substring(F.uuid(), 1, 12).alias("snapshot_id"),
        F.to_date(now).alias("snapshot_date"),
        now.alias("snapshot_timestamp"),
        *pivoted.columns,
        F.lit(0).cast("long").alias("bq_query_bytes_month"),
        F.lit(0.0).alias("bq_query_tb_month"),
        F.lit(QUERY_LIMIT_TB).alias("bq_query_limit_tb"),
        F.lit(0.0).alias("bq_query_usage_pct"),
        F.to_json(F.struct(F.lit(source).alias("source"))).alias("details"),
    )


# --- row counts ---


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table. Counts come from file footers where the frame is a plain Parquet scan."""
    result = None
    for name, rows in tables.items():
        one = rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        result = one if result is None else result.unionByName(one)
    return result


def layer_comparison(bronze: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """Rows per table in two layers, and the change from the first to the second."""
    before = table_counts(bronze).withColumnRenamed("row_count", "bronze_rows")
    after = table_counts(silver).withColumnRenamed("row_count", "silver_rows")
    return before.join(after, "table_name").withColumn("change", F.col("silver_rows") - F.col("bronze_rows"))


# --- age and query volume ---


def data_age_hours(sales: DataFrame, as_of, max_hours: int = MAX_AGE_HOURS) -> DataFrame:
    """Whole hours since midnight of the newest order day, and whether that is too long ago."""
    newest = sales.agg(F.max("order_date").alias("last_order_date"))
    seconds = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.col("last_order_date").cast("timestamp"))
    aged = newest.withColumn("hours_since_last_data", F.floor(seconds / 3600))
    return aged.withColumn("alert", F.col("hours_since_last_data") > max_hours)


def query_volume(jobs: DataFrame, as_of, days: int = 30, limit_gb: float = QUERY_ALERT_GB) -> DataFrame:
    """Gigabytes read by finished jobs of the last ``days`` days. ``jobs`` has creation_time, state and bytes."""
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    done = jobs.filter((F.col("creation_time") > since) & (F.col("state") == "DONE"))
    read = done.agg(F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / GIB, 2).alias("query_gb"))
    return read.withColumn("alert", F.col("query_gb") > limit_gb)


def daily_query_cost(jobs: DataFrame, as_of, days: int = 30, price_per_tb: float = PRICE_PER_TB) -> DataFrame:
    """Terabytes read and their price per day, newest first."""
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    recent = jobs.filter(F.col("creation_time") >= since)
    per_day = recent.groupBy(F.to_date("creation_time").alias("query_date")).agg(F.sum("bytes").alias("bytes"))
    return per_day.select(
        "query_date",
        (F.col("bytes") / 10**12).alias("tb_processed"),
        F.round(F.col("bytes") * price_per_tb / 10**12, 2).alias("estimated_cost"),
    ).orderBy(F.desc("query_date"))
