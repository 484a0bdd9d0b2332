"""Files are taken in as they land: micro-batches of new files, validated like a batch load.

The file source's checkpoint remembers which files were taken. A batch is one entry of the store's log, named by the stream and
the batch's number: a batch that failed has left nothing, and one that is repeated after it was committed does nothing. A
file that is delivered again is a new file: its rows are appended, and the silver layer keeps one row per key. Items are
kept even when their order has not landed yet; :mod:`tillflow.streaming.late_items` holds them back, or the silver layer
decides. Files of zero bytes, which Spark's sources do not show, are rejected with the first batch that has
files of their day.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.schemas import FileSpec
from tillflow.session import together
from tillflow.sources.landing import MAX_FILE_BYTES, ROOT, judge, relative_path, route, split_files, store_landing, whole_files
from tillflow.sources.tables import TableStore, list_beside


def file_texts(spark: SparkSession, path: str, spec: FileSpec, root: str = ROOT, files_per_batch: int = 1000) -> DataFrame:
    """New files of one kind, each as one text."""
    return whole_files(spark.readStream.option("maxFilesPerTrigger", files_per_batch), path, spec, root)


def empty_files(due: DataFrame, spec: FileSpec, store: TableStore, root: str = ROOT) -> DataFrame:
    """Files of zero bytes beside the files of a batch that are not reported yet: ``source_file, length``.

    A shop has a folder of its own in the folder of a day, so the days of the batch's files are listed, no others, and only
    the reports that are younger than the empty files are read.
    """
    spark = due.sparkSession
    days = due.select(F.regexp_replace("source_file", "/[^/]*/[^/]*$", "")).distinct().collect()
    found = list_beside(spark, [row[0] for row in days], spec.base_name).filter("length = 0")
    found = found.filter(route(F.col("path"), root) == spec.table).select(F.col("uri").alias("source_file"), "length", "modificationTime").collect()
    if not found:
        return due.select("source_file", "length").limit(0)
    empty = spark.createDataFrame([(f[0], f[1]) for f in found], "source_file string, length bigint")
    if not store.exists("quarantine.reports"):
        return empty
    since = F.date_sub(F.lit(min(f[2] for f in found)).cast("date"), 1)
    known = store.read("quarantine.reports").filter(F.col("_report_date") >= since).select(F.col("source_file").alias("_known"))
    return empty.join(known, relative_path(F.col("source_file"), root) == F.col("_known"), "left_anti")


def load_batch(
    texts: DataFrame,
    spec: FileSpec,
    store: TableStore,
    root: str = ROOT,
    as_of=None,
    max_bytes: int = MAX_FILE_BYTES,
    batch: tuple[str, int] | None = None,
) -> None:
    """Validate one micro-batch; valid rows go to bronze, rejected files to quarantine, all at once.

    ``batch`` names the batch over all its attempts.
    """
    if batch and store.committed(batch):
        return
    due = texts.select(F.col("file").alias("source_file"), F.col("size").alias("length")).persist()
    try:
        # The large ones are never held as one text. Empty files are looked for while the others are parsed.
        small = texts.filter(F.col("size") <= max_bytes)
        (rows, broken), empty = together(texts.sparkSession, lambda: split_files(small, spec), lambda: empty_files(due, spec, store, root))
        landing = judge(rows, broken, due.unionByName(empty), spec, root, max_bytes)
        store_landing(landing, spec, store, root, as_of, batch)
    finally:
        due.unpersist()


def ingest_stream(
    spark: SparkSession,
    path: str,
    spec: FileSpec,
    store: TableStore,
    checkpoint: str,
    root: str = ROOT,
    as_of=None,
    files_per_batch: int = 1000,
    available_now: bool = True,
    max_bytes: int = MAX_FILE_BYTES,
) -> StreamingQuery:
    """Start the ingestion of one kind of file. With ``available_now`` it stops once all present files are in."""
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def take(texts: DataFrame, number: int) -> None:
        load_batch(texts, spec, store, root, as_of, max_bytes, (f"{spec.table}_{stream}", number))

    writer = (
        file_texts(spark, path, spec, root, files_per_batch)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .queryName(f"ingest_{spec.table}")
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
