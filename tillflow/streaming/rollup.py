"""Stateful operators over event streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

DELAY = "2 hours"


def drop_redelivered(events: DataFrame, key: str, time: str = "ts", within: str = DELAY) -> DataFrame:
    """Each event once, when its repeats come within the delay. Older keys leave the state."""
    return events.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def window_label(start: Column, hours: int) -> Column:
    """The tag of a business window: window_1012 for ten to twelve; midnight as an end is 00."""
    end = F.date_format(start + F.make_dt_interval(hours=F.lit(hours)), "HH")
    return F.concat(F.lit("window_"), F.date_format(start, "HH"), end)


def rollup_by_window(
    events: DataFrame, by: str, measure: str, time: str = "ts", hours: int = 2, delay: str = DELAY
) -> DataFrame:
    """Count and sum per window and group.

    In append mode a window comes out once, when the watermark has passed its end; in update mode (see
    :func:`upsert_available`) it comes out whenever it has changed, open windows too.
    """
    windows = events.withWatermark(time, delay).groupBy(F.window(time, f"{hours} hours").alias("w"), by)
    sums = windows.agg(F.count(F.lit(1)).alias("event_count"), F.sum(measure).alias("total"))
    return sums.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        window_label(F.col("w.start"), hours).alias("window_label"),
        by,
        "event_count",
        "total",
    )


def write_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what the source holds now to a Parquet folder, and stop."""
    query: StreamingQuery = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write what changed in each micro-batch of what the source holds now, one folder a batch, and stop.

    A batch that is repeated replaces its folder. :func:`current_windows` reads the last state of every window.
    """

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def current_windows(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The last row written for each key."""
    states = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    rest = [name for name in schema.names if name not in keys]
    last = states.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
    return last.select(*keys, "_last.*").select(*schema.names)
