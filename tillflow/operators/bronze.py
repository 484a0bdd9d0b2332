"""Validated rows turned into bronze rows, and upkeep of small keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.schemas import BRONZE, FileSpec, ReferenceSpec


def _stamp(as_of) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def to_bronze(valid: DataFrame, spec: FileSpec, as_of=None) -> DataFrame:
    """Rename the landing columns and add where and when each row came in."""
    stamped = valid.withColumnsRenamed(spec.renames).withColumns(
        {"_ingest_timestamp": _stamp(as_of), "_ingest_date": F.to_date(_stamp(as_of))}
    )
    return stamped.select(*BRONZE[spec.table].names)


def reference_to_bronze(rows: DataFrame, spec: ReferenceSpec, as_of=None) -> DataFrame:
    """A reference table in its bronze types, with the ingest time the landing file lacks."""
    named = rows.withColumnsRenamed(spec.renames).withColumn("_ingest_timestamp", _stamp(as_of))
    return named.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in BRONZE[spec.table]])


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The incoming rows whose key is not there yet; the first of equal incoming keys by its other columns."""
    rest = [F.col(name) for name in incoming.columns if name != key]
    first = incoming.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    fresh = first.join(existing.select(key), key, "left_anti")
    return fresh.select(key, "_row.*").select(*incoming.columns)


def bronze_summary(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.sum("vlr_pedido"), 2).alias("total_value"),
    )


def latest_ingested(rows: DataFrame, key: str, limit: int = 5) -> DataFrame:
    return rows.orderBy(F.desc("_ingest_timestamp"), F.asc(key)).limit(limit)
