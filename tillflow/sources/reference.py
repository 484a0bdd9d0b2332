"""Reference tables: extracted from a relational source to files, and loaded from files to bronze."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators.bronze import reference_to_bronze
from tillflow.schemas import REFERENCE_SPECS, ReferenceSpec
from tillflow.sources.tables import replace_folder

# Seconds to wait before each new try.
RETRY_SECONDS = (30, 60, 120)
_STATUS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)


def jdbc_reader(
    spark: SparkSession, url: str, properties: dict[str, str], partitions: int = 8
) -> Callable[[ReferenceSpec], DataFrame]:
    """A reader of the relational source. Needs the source's JDBC driver on the class path.

    A table is read in ranges of its key, so that no task gets all of it.
    """

    def read(spec: ReferenceSpec) -> DataFrame:
        key = spec.key
        ends = f"(SELECT min({key}) AS low, max({key}) AS high FROM {spec.source_table}) ends"
        low, high = spark.read.jdbc(url, ends, properties=properties).first()
        if low is None:
            rows = spark.read.jdbc(url, spec.source_table, properties=properties)
        else:
            rows = spark.read.jdbc(
                url, spec.source_table, key, int(low), int(high) + 1, partitions, properties=properties
            )
        return rows.select(*spec.renames.values())

    return read


def with_retry(action: Callable, waits=RETRY_SECONDS, sleep: Callable[[float], None] = time.sleep):
    """Run ``action`` up to as many times as there are waits, waiting after each failure but the last."""
    for attempt, wait in enumerate(waits):
        try:
            return action()
        except Exception:
            if attempt == len(waits) - 1:
                raise
            sleep(wait)


def extract_reference(
    spark: SparkSession, read: Callable[[ReferenceSpec], DataFrame], target: str, waits=RETRY_SECONDS, sleep=time.sleep
) -> DataFrame:
    """Write each source table, ordered by key, as a file below ``target``; one status row per table.

    An empty source table is skipped and what was extracted before stays.
    """

    def extract_one(spec: ReferenceSpec) -> tuple[str, str, int]:
        rows = read(spec)
        if rows.isEmpty():
            return spec.source_table, "skipped", 0
        header = {bronze: landing for landing, bronze in spec.renames.items()}
        folder = f"{target}/{spec.file_name}"
        ordered = rows.orderBy(spec.key).withColumnsRenamed(header)
        ordered.write.mode("overwrite").option("sep", ";").option("header", True).csv(f"{folder}.new")
        replace_folder(spark, f"{folder}.new", folder)
        written = spark.read.schema(_text_schema(spec)).option("sep", ";").option("header", True).csv(folder)
        return spec.source_table, "success", written.count()

    outcome = [with_retry(lambda spec=spec: extract_one(spec), waits, sleep) for spec in REFERENCE_SPECS]
    return spark.createDataFrame(outcome, _STATUS)


def extract_summary(status: DataFrame) -> DataFrame:
    """Extracted and skipped tables and the rows extracted, as one row. There are four reference tables."""

    def names(value: str):
        return F.sort_array(F.collect_list(F.when(F.col("status") == value, F.col("table_name"))))

    return status.agg(
        names("success").alias("tables_extracted"),
        names("skipped").alias("tables_skipped"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
    )


def _text_schema(spec: ReferenceSpec) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in spec.renames])


def read_reference(spark: SparkSession, folder: str, spec: ReferenceSpec, as_of=None) -> DataFrame:
    """One reference file in bronze columns. Header names are checked against the expected ones."""
    reader = spark.read.schema(_text_schema(spec)).option("sep", ";").option("header", True)
    rows = reader.option("enforceSchema", False).csv(f"{folder}/{spec.file_name}")
    return reference_to_bronze(rows, spec, as_of)


def load_reference(spark: SparkSession, folder: str, store, as_of=None) -> DataFrame:
    """Replace the four bronze reference tables; one row per table with its row count or its error.

    A table whose file cannot be read stays as it was.
    """
    outcome = []
    for spec in REFERENCE_SPECS:
        try:
            rows = read_reference(spark, folder, spec, as_of)
            store.write(f"bronze.{spec.table}", rows)
            outcome.append((spec.table, "loaded", store.read(f"bronze.{spec.table}").count()))
        except Exception as error:  # noqa: BLE001 - one bad file must not stop the other tables
            outcome.append((spec.table, f"error: {error}"[:500], 0))
    return spark.createDataFrame(outcome, _STATUS)
