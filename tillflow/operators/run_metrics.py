"""Rows of the pipeline metrics table: run summaries and events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_LIMIT = 500


def _rows(metrics: DataFrame, dag_id: str, run_id: str, task_id: str, day: date, as_of) -> DataFrame:
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return metrics.select(
        F.substring(F.uuid(), 1, 12).alias("metric_id"),
        F.lit(dag_id).alias("dag_id"),
        F.lit(run_id).alias("dag_run_id"),
        F.lit(task_id).alias("task_id"),
        "metric_name",
        F.col("metric_value").cast("double").alias("metric_value"),
        "metric_unit",
        F.lit(day).alias("execution_date"),
        now.alias("execution_timestamp"),
        "details",
    )


def _metric(name: str, value: Column, unit: str, details: Column | None = None) -> Column:
    return F.struct(
        F.lit(name).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        F.lit(unit).alias("metric_unit"),
        (F.lit("{}") if details is None else F.to_json(details)).alias("details"),
    )


def run_summary(
    counts: DataFrame, dag_id: str, day: date, seconds: float, run_id: str = "", succeeded: bool = True, as_of=None
) -> DataFrame:
    """Status, duration and rows of a run. ``counts`` has one row per table it wrote, with ``row_count``."""
    measured = counts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"))
    metrics = F.array(
        _metric("pipeline_status", F.lit(1.0 if succeeded else 0.0), "boolean"),
        _metric("duration", F.lit(float(seconds)), "seconds"),
        _metric("rows_processed", F.col("rows"), "rows"),
    )
    return _rows(measured.select(F.inline(metrics)), dag_id, run_id, "notify_completion", day, as_of)


def quality_failure(
    failed: DataFrame, dag_id: str, day: date, run_id: str = "", as_of=None
) -> DataFrame:
    """Number and names of the failed checks. A run has a handful of checks, so the names fit one row."""
    measured = failed.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("check_name")).alias("names"))
    details = F.struct(F.col("names").alias("failed_checks"))
    metrics = F.array(_metric("quality_failure", F.col("n"), "checks", details))
    return _rows(measured.select(F.inline(metrics)), dag_id, run_id, "", day, as_of)


def task_failure(spark, dag_id: str, task_id: str, error: str, day: date, run_id: str = "", as_of=None) -> DataFrame:
    details = F.struct(F.lit(str(error)[:ERROR_LIMIT]).alias("error"))
    metrics = F.array(_metric("task_failure", F.lit(1.0), "event", details))
    return _rows(spark.range(1).select(F.inline(metrics)), dag_id, run_id, task_id, day, as_of)


def sla_miss(spark, dag_id: str, tasks: list[str], blocking: list[str], day: date, as_of=None) -> DataFrame:
    def names(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    details = F.struct(names(tasks).alias("tasks"), names(blocking).alias("blocking_tasks"))
    metrics = F.array(_metric("sla_miss", F.lit(1.0), "event", details))
    return _rows(spark.range(1).select(F.inline(metrics)), dag_id, "", "", day, as_of)


def event_metrics(events: DataFrame) -> DataFrame:
    """Metric rows out of a table of run events, one row per event.

    ``events`` has kind (sla_miss, task_failure, quality_failure), dag_id, dag_run_id, task_id, ts, error (text)
    and checks (array of names). A failed-check event counts its checks, the others count one.
    """
    kind = F.col("kind")
    details = (
        F.when(kind == "task_failure", F.to_json(F.struct(F.left("error", F.lit(ERROR_LIMIT)).alias("error"))))
        .when(kind == "quality_failure", F.to_json(F.struct(F.col("checks").alias("failed_checks"))))
        .when(kind == "sla_miss", F.to_json(F.struct(F.array("task_id").alias("tasks"))))
    )
    return events.filter(kind.isin("sla_miss", "task_failure", "quality_failure")).select(
        "dag_id",
        "dag_run_id",
        "task_id",
        kind.alias("metric_name"),
        F.when(kind == "quality_failure", F.array_size("checks")).otherwise(1).cast("double").alias("metric_value"),
        F.when(kind == "quality_failure", "checks").otherwise("event").alias("metric_unit"),
        F.to_date("ts").alias("execution_date"),
        F.col("ts").alias("execution_timestamp"),
        details.alias("details"),
    )
