"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings that every job of this package expects. AQE coalesces small shuffle partitions, splits skewed
# join partitions and skewed rebalance partitions at run time, so none of them is tied to a data size.
SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "tillflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the package settings; ``extra`` holds further settings, dots written as ``__``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Partitions that a shuffle begins with, for each core. AQE merges the small ones, and cannot make more of too few.
PARTITIONS_PER_CORE = 32
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def spread_shuffles(spark: SparkSession) -> None:
    """Let shuffles begin with many partitions, unless the session says with how many.

    Otherwise ``spark.sql.shuffle.partitions`` is the most that AQE has. A session that has set a small number for small tables
    then sorts large ones in a few tasks, which spill, and what they spill grows faster than the tables.
    """
    if spark.conf.get(_INITIAL, None) is None:
        wanted = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
        spark.conf.set(_INITIAL, str(max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local session may fall back to a folder of its own: on a cluster a machine-local folder would
    be lost with its executor, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tillflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that later jobs neither recompute nor lose it."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: Counter[str] = Counter()
_writing_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Writes that begin in here remove the files of their shuffles when they end, unless the session says what to do with them.

    Otherwise these stay until the driver's garbage collector meets the plans, and a job of many writes holds the shuffles of all on
    disk. Nothing reads them again: the plan of a write is its own, and what it wrote is read from the files.
    """
    application = spark.sparkContext.applicationId
    with _writing_lock:  # writes run at the same time; the last one to end gives the setting back
        if not _writing[application] and spark.conf.get(_CLEANUP, None) is not None:
            application = None
        else:
            _writing[application] += 1
            spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _writing_lock:
            if application is not None:
                _writing[application] -= 1
                if not _writing[application]:
                    spark.conf.unset(_CLEANUP)


def stage(df: DataFrame) -> DataFrame:
    """``df`` written to a folder of its own in the shared folder and read back: computed once, with sizes that Spark knows."""
    path = f"{shared_dir(df.sparkSession)}/tillflow/staged/{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable) -> list:
    """Run steps that do not need each other at the same time; Spark shares the executors among their jobs.

    Returns what they give, in their order. All have ended when this returns or raises.
    """
    with ThreadPoolExecutor(max(1, min(len(steps), 8))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in started]
