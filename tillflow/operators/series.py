"""Operators over metric samples: a frame of ts, host, name, value, and optional label columns.

A series is one (host, name) pair, or whatever ``by`` names. A single series may hold a large share of all
samples, so nothing here sorts a whole series in one task: samples are first combined per series and short
time slice, and only those slices are put in order per series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.operators.ranking import quantile_by

SERIES = ("host", "name")
#: Minutes that a sample speaks for.
STALE_MINUTES = 5


# A window is cut into this many slices before samples are put in order.
SLICES_PER_WINDOW = 60


def _step(before: Column, now: Column) -> Column:
    """Increase of a counter from one value to the next; a smaller value is a restart from zero."""
    return F.when(before.isNull(), None).when(now >= before, now - before).otherwise(now)


def _combine(parts: DataFrame, group: list[str]) -> DataFrame:
    """Join neighbouring stretches of a counter into one per group.

    A stretch has its position, its first and last value and the increase within it.
    """
    in_order = W.partitionBy(*group).orderBy("_at")
    stepped = parts.withColumn("_gap", _step(F.lag("_last").over(in_order), F.col("_first")))
    return stepped.groupBy(*group).agg(
        F.min("_at").alias("_at"),
        F.min_by("_first", "_at").alias("_first"),
        F.max_by("_last", "_at").alias("_last"),
        (F.sum("_inner") + F.coalesce(F.sum("_gap"), F.lit(0))).alias("_inner"),
    )


def counter_rate(samples: DataFrame, by=SERIES, minutes: int = 5, order=("ts",)) -> DataFrame:
    """Increase of a counter and its rate per second, per series and time window.

    The increase adds up the steps between neighbouring samples; a step down is a restart from zero. The
    step from the last sample before a window counts in that window; the first sample ever has no step.
    Samples are combined to slices, slices to windows, and windows are put in order per series.
    """
    by, seconds = list(by), minutes * 60
    value = F.col("value")
    parts = samples.select(
        *by,
        F.window("ts", f"{seconds} seconds")["start"].alias("window_start"),
        F.floor(F.unix_micros("ts") / (seconds * 1_000_000 / SLICES_PER_WINDOW)).alias("_slice"),
        F.struct(*order).alias("_at"),
        value.alias("_first"),
        value.alias("_last"),
        (value - value).alias("_inner"),
    )
    slices = _combine(parts, [*by, "window_start", "_slice"])
    windows = _combine(slices, [*by, "window_start"])
    previous = F.lag("_last").over(W.partitionBy(*by).orderBy("window_start"))
    gap = F.coalesce(_step(previous, F.col("_first")), F.lit(0))
    rates = windows.withColumn("increase", F.col("_inner") + gap).select(*by, "window_start", "increase")
    return rates.withColumn("rate", F.col("increase").cast("double") / seconds)


def rate_by(samples: DataFrame, label: str, by=SERIES, minutes: int = 5, order=("ts",)) -> DataFrame:
    """Rates summed over all series that share a label, per window."""
    rates = counter_rate(samples, [*dict.fromkeys([*by, label])], minutes, order)
    summed = rates.groupBy(label, "window_start").agg(F.sum("increase").alias("increase"))
    return summed.withColumn("rate", F.col("increase").cast("double") / (minutes * 60))


def cpu_percent(samples: DataFrame, idle: str, by=SERIES, minutes: int = 5, order=("ts",)) -> DataFrame:
    """100 minus the average idle rate over all series of the idle counter, in percent, per window."""
    rates = counter_rate(samples.filter(F.col("name") == idle), by, minutes, order)
    total, n = F.sum("increase"), F.count(F.lit(1))
    busy = F.lit(100) - total.cast("double") / n / (minutes * 60) * 100
    return rates.groupBy("window_start").agg(busy.alias("cpu_pct"))


def latest_values(samples: DataFrame, by=SERIES, order=("ts",)) -> DataFrame:
    return samples.groupBy(*by).agg(F.max_by("value", F.struct(*order)).alias("value"))


def gauge_percent(samples: DataFrame, available: str, total: str, order=("ts",)) -> DataFrame:
    """Share in use per host, from the latest available and total gauges. One pass, no join."""
    position = F.struct(*order)

    def latest(name: str) -> Column:
        of = F.col("name") == name
        return F.max_by(F.when(of, F.col("value")), F.when(of, position))

    latest_pair = (
        samples.filter(F.col("name").isin(available, total))
        .groupBy("host")
        .agg(latest(available).alias("_available"), latest(total).alias("_total"))
        .filter(F.col("_available").isNotNull() & F.col("_total").isNotNull())
    )
    share = F.col("_available").cast("double") / F.nullif(F.col("_total").cast("double"), F.lit(0.0))
    return latest_pair.select("host", ((F.lit(1) - share) * 100).alias("used_pct"))


def _per_minute(samples: DataFrame, by: list[str], order) -> DataFrame:
    """The last value of each minute: a rule is evaluated once a minute."""
    minute = F.date_trunc("minute", "ts").alias("minute")
    return samples.groupBy(*by, minute).agg(F.max_by("value", F.struct(*order)).alias("value"))


def _beyond(threshold, comparison: Column) -> Column:
    return F.when(comparison == "gt", F.col("value") > threshold).otherwise(F.col("value") < threshold)


def _stretches(minutes: DataFrame, by: list[str], stale_minutes: int) -> DataFrame:
    """Runs of minutes that are ``_beyond``, per series.

    A sample counts for ``stale_minutes``; a longer gap ends the run, as nothing is known about it.
    """
    in_order = W.partitionBy(*by).orderBy("minute")
    gap = F.unix_timestamp("minute") - F.unix_timestamp(F.lag("minute").over(in_order))
    goes_on = F.coalesce(F.lag("_beyond").over(in_order) & (gap <= 60 * stale_minutes), F.lit(False))
    started = F.col("_beyond") & ~goes_on
    numbered = minutes.withColumn("_started", started.cast("int")).withColumn(
        "_run", F.sum("_started").over(in_order.rowsBetween(W.unboundedPreceding, 0))
    )
    runs = numbered.filter("_beyond").groupBy(*by, "_run")
    found = runs.agg(
        F.min("minute").alias("breach_start"),
        F.max("minute").alias("breach_end"),
        F.count(F.lit(1)).alias("evaluations"),
    )
    held = F.floor((F.unix_timestamp("breach_end") - F.unix_timestamp("breach_start")) / 60)
    return found.drop("_run").withColumn("held_minutes", held)


def sustained_breaches(
    samples: DataFrame,
    threshold: float,
    hold_minutes: int,
    comparison: str = "gt",
    by=SERIES,
    order=("ts",),
    stale_minutes: int = STALE_MINUTES,
) -> DataFrame:
    """Stretches in which the value stayed beyond the threshold for at least ``hold_minutes``.

    Samples shrink to one row per series and minute before they are put in order.
    """
    by = list(by)
    minutes = _per_minute(samples, by, order).withColumn("_beyond", _beyond(threshold, F.lit(comparison)))
    return _stretches(minutes, by, stale_minutes).filter(F.col("held_minutes") >= hold_minutes)


# The alert rules - name, metric, comparison, threshold, minutes it must hold, state without data.
ALERT_RULES = (
    ("High CPU Usage", "cpu_pct", "gt", 90, 5, "NoData"),
    ("High Memory Usage", "memory_pct", "gt", 85, 5, "NoData"),
    ("High Disk Usage", "disk_pct", "gt", 80, 5, "NoData"),
    ("Critical Disk Usage", "disk_pct", "gt", 95, 1, "NoData"),
    ("Node Exporter Down", "exporter_up", "lt", 1, 2, "Alerting"),
    ("Prometheus Target Down", "targets_up", "lt", 2, 5, "Alerting"),
)
_RULE_FIELDS = ("alert", "metric", "comparison", "threshold", "hold", "no_data")


def _rule_table(rules) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(_RULE_FIELDS, rule, strict=True)]) for rule in rules])


def alerts(
    metrics: DataFrame, rules=ALERT_RULES, by=SERIES, order=("ts",), stale_minutes: int = STALE_MINUTES
) -> DataFrame:
    """The stretches in which an alert rule fired. ``metrics`` holds the metrics of the rules, by name.

    All rules are evaluated in one pass: every minute of a metric is paired with the rules on that metric.
    """
    by = list(by)
    table = _rule_table(rules)
    watched = metrics.filter(F.col("name").isin(*{rule[1] for rule in rules}))
    paired = _per_minute(watched, by, order).withColumn(
        "_rule", F.explode(F.filter(table, lambda rule: rule["metric"] == F.col("name")))
    )
    minutes = paired.select(
        *by,
        "minute",
        F.col("_rule.alert").alias("alert"),
        F.col("_rule.hold").alias("_hold"),
        _beyond(F.col("_rule.threshold"), F.col("_rule.comparison")).alias("_beyond"),
    )
    fired = _stretches(minutes, [*by, "alert", "_hold"], stale_minutes)
    return fired.filter(F.col("held_minutes") >= F.col("_hold")).drop("_hold")


def alerts_without_data(
    metrics: DataFrame, as_of, rules=ALERT_RULES, by=SERIES, stale_minutes: int = STALE_MINUTES
) -> DataFrame:
    """The rules whose series has been silent for too long at ``as_of``, with the state that the rule takes then.

    A rule without any series is silent too; its row has null series columns.
    """
    by, now = list(by), F.lit(as_of).cast("timestamp")
    listed = metrics.sparkSession.range(1).select(F.inline(_rule_table(rules))).select("alert", F.col("metric").alias("_metric"), "no_data")
    last = metrics.filter("ts IS NOT NULL").groupBy(*by).agg(F.max("ts").alias("last_seen"))
    silent = F.col("last_seen").isNull() | (F.unix_timestamp(now) - F.unix_timestamp("last_seen") > 60 * stale_minutes)
    found = listed.join(last.withColumn("_name", F.col("name")), F.col("_metric") == F.col("_name"), "left")
    return found.filter(silent).select(*by, "alert", "last_seen", F.col("no_data").alias("state"))


def targets_up(samples: DataFrame, by=SERIES, up: str = "up", order=("ts",), minimum: int = 2) -> DataFrame:
    """Sum of the latest state of all targets, and whether too few are up."""
    latest = latest_values(samples.filter(F.col("name") == up), by, order)
    return latest.agg(F.coalesce(F.sum("value"), F.lit(0)).alias("targets_up")).withColumn(
        "alert", F.col("targets_up") < minimum
    )


# Dotted names of the scheduler's metrics, the metric each becomes, and the label that each
# star stands for. The first rule that matches wins; the last one takes every other name of the scheduler.
NAME_RULES = (
    ("airflow.dag.*.*.duration", "airflow_dag_task_duration_seconds", ("dag_id", "task_id")),
    ("airflow.dagrun.duration.*.*.success", "airflow_dagrun_duration_success_seconds", ("dag_id", "run_id")),
    ("airflow.dagrun.duration.*.*.failed", "airflow_dagrun_duration_failed_seconds", ("dag_id", "run_id")),
    ("airflow.dag_processing.total_parse_time", "airflow_dag_processing_total_parse_time_seconds", ()),
    ("airflow.scheduler.tasks.running", "airflow_scheduler_tasks_running", ()),
    ("airflow.scheduler.tasks.starving", "airflow_scheduler_tasks_starving", ()),
    ("airflow.ti.start.*.*", "airflow_task_instance_started_total", ("dag_id", "task_id")),
    ("airflow.ti.finish.*.*.*", "airflow_task_instance_finished_total", ("dag_id", "task_id", "state")),
    ("airflow.*", "airflow_${1}", ("airflow_metric",)),
)


def parse_metric_name(dotted: Column) -> Column:
    """A struct of metric name and label map; null when no rule matches. A star is one part of the name."""
    parsed = F.lit(None)
    for pattern, name, labels in reversed(NAME_RULES):
        regex = "^" + r"([^.]+)".join(part.replace(".", r"\.") for part in pattern.split("*")) + "$"
        captured = [F.regexp_extract(dotted, regex, i + 1) for i in range(len(labels))]
        pairs = [cell for label, value in zip(labels, captured, strict=True) for cell in (F.lit(label), value)]
        metric = F.concat(F.lit(name.replace("${1}", "")), captured[0]) if "${1}" in name else F.lit(name)
        label_map = (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")
        parsed = F.when(dotted.rlike(regex), F.struct(metric.alias("metric"), label_map.alias("labels"))).otherwise(parsed)
    return parsed


def slo_by_hour(samples: DataFrame, duration: str, success: str, failure: str) -> DataFrame:
    """Per hour: 95th percentile of durations, success rate and failures, each with its alert level.

    The percentile is the least duration that 95 of 100 do not exceed, exactly, without an hour's durations in one task.
    """
    of = {name: F.col("name") == name for name in (duration, success, failure)}
    timed = samples.withColumn("hour", F.date_trunc("hour", "ts"))
    hours = timed.groupBy("hour").agg(F.count_if(of[success]).alias("successes"), F.count_if(of[failure]).alias("failures"))
    slowest = quantile_by(timed.filter(of[duration]), "hour", "value", 95).withColumnRenamed("quantile", "p95_duration")
    hours = hours.join(slowest, "hour", "left")
    runs = F.nullif(F.col("successes") + F.col("failures"), F.lit(0))
    rated = hours.withColumn("success_pct", F.round(F.col("successes") * F.lit(100).cast("decimal(10,0)") / runs, 2).cast("double"))
    # The alert levels
    return rated.select(
        "hour",
        "p95_duration",
        "success_pct",
        "failures",
        (F.col("p95_duration") > 600).alias("slow"),
        (F.col("success_pct") < 95).alias("unreliable"),
        (F.col("failures") > 5).alias("failing"),
    )


def heartbeat_age(samples: DataFrame, as_of, by=SERIES, max_seconds: int = 300) -> DataFrame:
    """Seconds since the last sample of each series, and whether that is too long ago."""
    last = samples.groupBy(*by).agg(F.max("ts").alias("last_seen"))
    age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("last_seen")
    return last.withColumn("age_seconds", age).withColumn("alert", F.col("age_seconds") > max_seconds)
