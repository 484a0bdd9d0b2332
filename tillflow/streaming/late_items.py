"""Items that land before their order wait in the state of a stream until the order comes or their time is up.

Both streams have a watermark, and the join a range of time: an order is looked for from ``memory`` before an item until
``wait`` after it. So an item leaves the state when its order comes, or once the watermark is past its wait, and then comes
out without an order; an order leaves when no item can ask for it any more. The state lies in the checkpoint, so a stream
that is stopped and started again goes on with the items that were waiting. What it holds at a time is what landed within
wait and memory of the last files, however long the stream runs, if files land in the order of time (:func:`land_in_order`);
between two batches those of the batch before as well, which go when the next one comes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import stage, together
from tillflow.sources.tables import TableStore, below, file_system

RELEASED, EXPIRED = "stream.items_released", "stream.items_expired"
#: Bytes of the files of a span for each partition of the state. A partition costs the same in every batch, however little it holds.
STATE_BYTES = 4 << 20
_PARTITIONS = "spark.sql.shuffle.partitions"


def match_items(items: DataFrame, orders: DataFrame, wait: str, memory: str, delay: str, item_time: str = "_ingest_timestamp") -> DataFrame:
    """The columns of ``items``, and ``order_date`` and ``order_seen`` of their order, which are null for those that expired.

    ``items`` and ``orders`` are bronze streams. An item comes out for each delivery of its order within the range.
    """
    left = items.withWatermark(item_time, delay)
    right = orders.select(
        F.col("id_pedido").alias("_order_id"), F.col("data_pedido").alias("order_date"), F.col("_ingest_timestamp").alias("order_seen")
    ).withWatermark("order_seen", delay)
    in_range = (F.col("order_seen") >= F.col(item_time) - F.expr(f"INTERVAL {memory}")) & (
        F.col("order_seen") <= F.col(item_time) + F.expr(f"INTERVAL {wait}")
    )
    return left.join(right, (F.col("id_pedido") == F.col("_order_id")) & in_range, "left_outer").drop("_order_id")


def state_partitions(spark: SparkSession, apart: dict[str, str]) -> int:
    """Partitions for the state of a stream over what :func:`set_apart` wrote: by the bytes of the largest span, one a core at least.

    A join keeps four stores a partition, which are opened and committed in every batch, and a checkpoint never changes its number.
    """
    sizes: dict[str, int] = {}
    for source in apart.values():
        for status in below(*file_system(spark, source)):
            span = status.getPath().getParent().getName()
            sizes[span] = sizes.get(span, 0) + status.getLen()
    return max(spark.sparkContext.defaultParallelism, -(-max(sizes.values(), default=0) // STATE_BYTES))


@contextmanager
def _shuffled_by(spark: SparkSession, partitions: int | None):
    """A stream takes its settings along when it starts; the session has its own again after that."""
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, str(partitions or before))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


def store_matches(
    matches: DataFrame, store: TableStore, stream: str, checkpoint: str, landing: Iterator | None = None, partitions: int | None = None
) -> None:
    """Write what can be decided now and stop: items with their order to RELEASED, the others to EXPIRED, in one commit a batch.

    The rows of a batch are computed once, since each pass over them runs the join and its state again. ``landing`` (of
    :func:`land_in_order`) brings further files after those that are there: the next ones land at the end of each batch and make the
    next one, so that the state is not loaded anew for them and only the last files are followed by a batch without any. ``partitions`` is the number of
    partitions that a new checkpoint gives the state; the session's without it.
    """

    def take(rows: DataFrame, number: int) -> None:
        if not store.committed((stream, number)):
            rows = stage(rows)
            released, expired = rows.filter("order_seen IS NOT NULL"), rows.filter("order_seen IS NULL").drop("order_date", "order_seen")
            with store.transaction((stream, number)) as changes:
                together(store.spark, lambda: changes.append(RELEASED, released), lambda: changes.append(EXPIRED, expired))
        if landing is not None:
            next(landing, None)

    writer = matches.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if landing is None:
        writer = writer.trigger(availableNow=True)
    with _shuffled_by(matches.sparkSession, partitions):
        query = writer.start()
    if landing is None:
        query.awaitTermination()
        return
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def item_states(items: DataFrame, store: TableStore) -> DataFrame:
    """``id_item_pedido, id_pedido, state`` of every item that was delivered: released, expired, or waiting still."""
    keys = ["id_item_pedido", "id_pedido"]
    decided = store.read(RELEASED).select(*keys, F.lit("released").alias("state")).distinct()
    decided = decided.unionByName(store.read(EXPIRED).select(*keys, F.lit("expired").alias("state")).distinct())
    waiting = items.select(*keys).distinct().join(decided, keys, "left_anti").withColumn("state", F.lit("waiting"))
    return decided.unionByName(waiting)


def stream_of(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """New Parquet files below a folder as a stream with the columns of ``like``."""
    return spark.readStream.schema(like.schema).parquet(folder)


def set_apart(rows: DataFrame, folder: str, days: int, time: str = "_ingest_timestamp") -> None:
    """Write rows to a folder for each span of some days, ready to land; those without a time come last."""
    span = F.format_string("%07d", F.floor(F.unix_date(F.to_date(time)) / days) + 1_000_000)
    spanned = rows.withColumn("_span", F.when(F.col(time).isNotNull(), span))
    spanned.hint("rebalance", "_span").write.partitionBy("_span").parquet(folder)


def land_in_order(spark: SparkSession, apart: dict[str, str]) -> Iterator[str]:
    """Move what :func:`set_apart` wrote into the folders of streams, span by span: ``{folder of a stream: folder set apart}``.

    All streams get a span before the next one comes, so a caller that takes the files in at every step (``landing`` of
    :func:`store_matches`) meets no row that is older than the watermark. Names of spans and files pass through the driver.
    """
    spans: dict[str, list[tuple[str, object]]] = {}
    for target, source in apart.items():
        files, folder = file_system(spark, source)
        file_system(spark, target)[0].mkdirs(file_system(spark, target)[1])
        for status in below(files, folder):
            if status.getPath().getName().startswith("part-"):
                spans.setdefault(status.getPath().getParent().getName(), []).append((target, status.getPath()))
    for span in sorted(spans):
        for target, path in spans[span]:
            files, place = file_system(spark, f"{target}/{span.partition('=')[2]}-{path.getName()}")
            if not files.rename(path, place):
                raise OSError(f"cannot move {path} to {place}")
        yield span
