"""Sustained breaches of a threshold over a stream of samples: the batch operator's result, batch by batch.

Each series has a small state: the last value of the minutes that the watermark has not passed yet, and the run of minutes
beyond the threshold that goes on. Minutes are decided in order once the watermark has passed them; a normal minute ends a run,
and so does silence, which a timer on the watermark notices. After every batch a series shows its runs, the final ones once
and the open ones as they stand, so that an alert does not wait for the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillflow.operators.series import STALE_MINUTES

MINUTE = 60_000_000  # microseconds
NO_RUN = (0, 0, 0, False)
STATE = "minutes array<bigint>, places array<bigint>, ties array<bigint>, beyond array<boolean>, start bigint, last bigint, n bigint"
_RUN = "_start bigint, _end bigint, evaluations bigint, final boolean"


def watch(samples: DataFrame, threshold: float, by: tuple[str, ...] = ("host", "name"), comparison: str = "gt", tie: str | None = None, delay: str = "1 hour", stale_minutes: int = STALE_MINUTES) -> DataFrame:
    """The runs of every series that a batch touches: ``by, breach_start, breach_end, evaluations, final``.

    Each series has a row without a run, too, so that a reader can tell that its open runs are gone. ``tie``, a whole number,
    decides which of the samples of one instant is the last. Samples without a time or value are left out.
    """
    beyond = F.col("value") > threshold if comparison == "gt" else F.col("value") < threshold
    at = F.unix_micros("ts")
    known = samples.filter("ts IS NOT NULL AND value IS NOT NULL").withWatermark("ts", delay)
    slim = known.select(*by, "ts", at.alias("_at"), (F.col(tie).cast("bigint") if tie else F.lit(0).cast("bigint")).alias("_tie"), beyond.alias("_beyond"))
    kinds = {f.name: f.dataType for f in slim.schema}
    output = T.StructType([T.StructField(name, kinds[name]) for name in by] + T._parse_datatype_string(_RUN).fields)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        minutes, start, last, n = _restore(state)
        if not state.hasTimedOut:
            for batch in batches:
                _take(minutes, batch)
        passed = state.getCurrentWatermarkMs() * 1000
        ready = sorted(m for m in minutes if m + MINUTE <= passed)
        closed, (start, last, n) = _runs(ready, minutes, (start, last, n), stale_minutes)
        for minute in ready:
            del minutes[minute]
        # A run is over when no sample that may still come can go on with it.
        if n and not minutes and last + (stale_minutes + 1) * MINUTE <= passed:
            closed, (start, last, n) = [*closed, (start, last, n)], (0, 0, 0)
        later, running = _runs(sorted(minutes), minutes, (start, last, n), stale_minutes)
        shown = [(*run, True) for run in closed] + [(*run, False) for run in [*later, running] if run[2]]
        _keep(state, minutes, start, last, n, passed, stale_minutes)
        yield pd.DataFrame([(*key, *run) for run in [*shown, NO_RUN]], columns=output.names)

    found = slim.groupBy(*by).applyInPandasWithState(step, output, STATE, "update", GroupStateTimeout.EventTimeTimeout)
    times = [F.when(F.col("evaluations") > 0, F.timestamp_micros(column)).alias(name) for column, name in (("_start", "breach_start"), ("_end", "breach_end"))]
    return found.select(*by, *times, "evaluations", "final")


def _restore(state: GroupState) -> tuple[dict, int, int, int]:
    """Pending minutes with place, tie and state of their last sample, and the run that goes on."""
    if not state.exists:
        return {}, 0, 0, 0
    minutes, places, ties, beyond, start, last, n = state.get
    return dict(zip(minutes, zip(places, ties, beyond, strict=True), strict=True)), start, last, n


def _take(minutes: dict, batch: pd.DataFrame) -> None:
    """Keep the last sample of every minute. Most series have a few rows a batch, for which operations on frames cost more than the rows."""
    for place, tie, beyond in zip(*[batch[name].tolist() for name in ("_at", "_tie", "_beyond")], strict=True):
        minute = place - place % MINUTE
        if minute not in minutes or minutes[minute][:2] <= (place, tie):
            minutes[minute] = (place, tie, beyond)


def _runs(order: list[int], minutes: dict, run: tuple[int, int, int], stale_minutes: int) -> tuple[list, tuple[int, int, int]]:
    """Runs that end within some minutes in order, and the one that goes on after them, from the one before them."""
    closed, (start, last, n) = [], run
    for minute in order:
        beyond = minutes[minute][2]
        if n and (not beyond or minute - last > stale_minutes * MINUTE):
            closed.append((start, last, n))
            n = 0
        if beyond:
            start, last, n = (start, minute, n + 1) if n else (minute, minute, 1)
    return closed, (start, last, n) if n else (0, 0, 0)


def _keep(state: GroupState, minutes: dict, start: int, last: int, n: int, passed: int, stale_minutes: int) -> None:
    if not minutes and not n:
        state.remove()
        return
    order = sorted(minutes)
    state.update((order, *[[minutes[m][i] for m in order] for i in range(3)], start, last, n))
    due = order[0] + MINUTE if order else last + (stale_minutes + 1) * MINUTE
    state.setTimeoutTimestamp(max(due, passed + 1000) // 1000 + 1)


def write_runs(runs: DataFrame, path: str, checkpoint: str) -> None:
    """Write the runs of each micro-batch of what the source holds now, one folder a batch, and stop."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = runs.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def sustained(written: DataFrame, hold_minutes: int, by: tuple[str, ...] = ("host", "name")) -> DataFrame:
    """The runs that held long enough, of what :func:`write_runs` wrote: the final ones, and the open ones of a series' last batch."""
    newest = written.withColumn("_newest", F.max("batch").over(W.partitionBy(*by)))
    runs = newest.filter(F.col("breach_start").isNotNull() & (F.col("final") | (F.col("batch") == F.col("_newest"))))
    held = F.floor((F.unix_timestamp("breach_end") - F.unix_timestamp("breach_start")) / 60)
    found = runs.select(*by, "breach_start", "breach_end", "evaluations", held.alias("held_minutes"))
    return found.filter(F.col("held_minutes") >= hold_minutes)
