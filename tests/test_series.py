from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators import series

START = datetime(2026, 1, 1)


def samples(spark, *points: tuple):
    """(second, value) or (second, value, host, name) points."""
    full = [(START + timedelta(seconds=p[0]), *((p[2], p[3]) if len(p) > 2 else ("h1", "m")), float(p[1])) for p in points]
    return spark.createDataFrame(full, "ts timestamp, host string, name string, value double")


def test_rate_counts_resets_and_steps_across_windows(spark):
    frame = samples(spark, (0, 10), (60, 40), (290, 100), (310, 130), (400, 20), (500, 50))
    found = series.counter_rate(frame).orderBy("window_start")
    # 30 + 60 inside the first window; 30 over the edge, 20 after the restart, 30 in the second
    assert rows(found, "increase", "rate") == [(90.0, 90 / 300), (80.0, 80 / 300)]


def test_rate_equals_the_plain_window(spark):
    from pyspark.sql import Window as W

    pick = random.Random(4)
    points = [(pick.randrange(7200) + i / 1000, pick.randrange(100), pick.choice(["a", "a", "a", "b"]), "m") for i in range(600)]
    frame = samples(spark, *points)
    before = F.lag("value").over(W.partitionBy("host", "name").orderBy("ts"))
    step = F.when(before.isNull(), 0).when(F.col("value") >= before, F.col("value") - before).otherwise(F.col("value"))
    plain = (
        frame.withColumn("s", step).groupBy("host", "name", F.window("ts", "5 minutes")["start"].alias("w")).agg(F.sum("s"))
    )
    assert sorted(rows(series.counter_rate(frame).drop("rate"))) == sorted(rows(plain))


def test_rate_by_label(spark):
    frame = samples(spark, (0, 0, "a", "m"), (30, 30, "a", "m"), (0, 0, "b", "m"), (30, 60, "b", "m"))
    assert rows(series.rate_by(frame, "name"), "increase", "rate") == [(90.0, 0.3)]


def test_cpu_percent(spark):
    frame = samples(spark, (0, 0, "a", "idle"), (299, 150, "a", "idle"), (0, 0, "b", "idle"), (299, 30, "b", "idle"), (5, 1, "b", "x"))
    assert rows(series.cpu_percent(frame, "idle"), F.round("cpu_pct", 6)) == [(70.0,)]


def test_gauge_percent_uses_the_latest_pair(spark):
    frame = samples(spark, (0, 90, "a", "free"), (9, 25, "a", "free"), (0, 100, "a", "all"), (0, 5, "b", "free"))
    assert rows(series.gauge_percent(frame, "free", "all")) == [("a", 75.0)]


@pytest.mark.parametrize(("hold", "expected"), [(5, 1), (1, 2), (6, 0)])
def test_breach_must_hold(spark, hold, expected):
    high = [(60 * m, 95) for m in range(6)]  # minutes 0 … 5
    again = [(600, 95), (660, 95)]
    frame = samples(spark, *high, (360, 10), *again, (720, 90))
    assert series.sustained_breaches(frame, 90, hold).count() == expected


def test_breach_uses_the_last_value_of_a_minute(spark):
    frame = samples(spark, (0, 95), (30, 10), (60, 95), (120, 95))
    found = series.sustained_breaches(frame, 90, 1)
    assert rows(found, "breach_start", "held_minutes", "evaluations") == [(START + timedelta(minutes=1), 1, 2)]
    assert series.sustained_breaches(frame, 11, 0, "lt").count() == 1


def test_targets_up(spark):
    frame = samples(spark, (0, 1, "a", "up"), (0, 1, "b", "up"), (5, 0, "b", "up"))
    assert rows(series.targets_up(frame)) == [(1.0, True)]


@pytest.mark.parametrize(
    ("dotted", "metric", "labels"),
    [
        ("airflow.dag.daily.load.duration", "airflow_dag_task_duration_seconds", {"dag_id": "daily", "task_id": "load"}),
        ("airflow.dagrun.duration.d.r1.success", "airflow_dagrun_duration_success_seconds", {"dag_id": "d", "run_id": "r1"}),
        ("airflow.dagrun.duration.d.r1.failed", "airflow_dagrun_duration_failed_seconds", {"dag_id": "d", "run_id": "r1"}),
        ("airflow.dag_processing.total_parse_time", "airflow_dag_processing_total_parse_time_seconds", {}),
        ("airflow.scheduler.tasks.running", "airflow_scheduler_tasks_running", {}),
        ("airflow.scheduler.tasks.starving", "airflow_scheduler_tasks_starving", {}),
        ("airflow.ti.start.d.t", "airflow_task_instance_started_total", {"dag_id": "d", "task_id": "t"}),
        ("airflow.ti.finish.d.t.failed", "airflow_task_instance_finished_total", {"dag_id": "d", "task_id": "t", "state": "failed"}),
        ("airflow.executor_slots", "airflow_executor_slots", {"airflow_metric": "executor_slots"}),
        ("airflow.some.other.name", None, None),
        ("node.load1", None, None),
    ],
)
def test_metric_names(spark, dotted, metric, labels):
    found = spark.createDataFrame([(dotted,)], "d string").select(series.parse_metric_name(F.col("d")).alias("p"))
    row = found.select("p.metric", "p.labels").first()
    assert (row.metric, row.labels) == (metric, labels)


def test_slo_and_heartbeat(spark):
    points = [(i, 100 + i, "a", "dur") for i in range(100)] + [(i, 1, "a", "ok") for i in range(18)] + [(i, 1, "a", "bad") for i in range(6)]
    found = series.slo_by_hour(samples(spark, *points), "dur", "ok", "bad")
    assert rows(found, "p95_duration", "success_pct", "failures", "slow", "unreliable", "failing") == [(194.0, 75.0, 6, False, True, True)]
    ages = series.heartbeat_age(samples(spark, (0, 1), (100, 1)), START + timedelta(seconds=401))
    assert rows(ages, "age_seconds", "alert") == [(301, True)]


def test_no_window_runs_over_raw_rows_of_a_whole_series(spark):
    """Windows over whole series work on rows that were combined per time slice first."""
    frame = samples(spark, (0, 1), (10, 2))
    for found in (series.counter_rate(frame), series.sustained_breaches(frame, 1, 0)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        whole_series = plan.index("Window [")
        assert "Aggregate [host" in plan[whole_series:]


def test_alert_rules_fire_by_metric(spark):
    points = [(60 * m, 90, "a", "disk_pct") for m in range(6)] + [(60 * m, 99, "b", "disk_pct") for m in range(2)]
    points += [(60 * m, 0, "a", "exporter_up") for m in range(3)] + [(60 * m, 91, "a", "unknown") for m in range(9)]
    found = series.alerts(samples(spark, *points))
    assert sorted(rows(found, "alert", "host", "held_minutes")) == [
        ("Critical Disk Usage", "b", 1), ("High Disk Usage", "a", 5), ("Node Exporter Down", "a", 2),
    ]
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_a_gap_ends_a_breach(spark):
    """Two samples ten hours apart say nothing about the time between them."""
    frame = samples(spark, (0, 99, "a", "disk_pct"), (36_000, 99, "a", "disk_pct"))
    assert series.sustained_breaches(frame, 95, 1).count() == 0
    assert series.alerts(frame).count() == 0
    assert series.sustained_breaches(frame, 95, 1, stale_minutes=600).count() == 1


def test_silent_series_take_the_state_of_their_rule(spark):
    frame = samples(spark, (0, 50, "a", "disk_pct"), (0, 1, "a", "exporter_up"), (590, 1, "b", "exporter_up"))
    found = series.alerts_without_data(frame, START + timedelta(seconds=600))
    assert sorted(rows(found, "alert", "host", "state"), key=str) == sorted([
        ("Critical Disk Usage", "a", "NoData"), ("High CPU Usage", None, "NoData"), ("High Disk Usage", "a", "NoData"),
        ("High Memory Usage", None, "NoData"), ("Node Exporter Down", "a", "Alerting"), ("Prometheus Target Down", None, "Alerting"),
    ], key=str)
