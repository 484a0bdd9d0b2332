"""Row and file validation of landing files.

The input of every function is a text frame: the cells of ``FileSpec.columns`` as strings, plus
``_source_file`` and ``_row``, a number that grows with the position of the row in its file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.functions.numbers import count_where
from tillflow.functions.text import typed
from tillflow.schemas import FileSpec

NO_VALID_ROWS = "No valid rows after validation"


def coerce(raw: DataFrame, spec: FileSpec) -> DataFrame:
    """Read the text cells as the types of the target table; what does not fit becomes null."""
    return raw.select(
        *[typed(F.col(name), kind).alias(name) for name, kind in spec.types.items()],
        "_source_file",
        "_row",
    )


def _complete(spec: FileSpec) -> Column:
    return reduce(Column.__and__, [F.col(name).isNotNull() for name in spec.required])


def _in_domain(spec: FileSpec) -> Column:
    rules = [F.col(name).isin(*values) for name, values in spec.domain.items()]
    return reduce(Column.__and__, rules, F.lit(True))


def valid_rows(raw: DataFrame, spec: FileSpec) -> DataFrame:
    """Rows that carry all required values and a known status; of equal keys in a file the first row stays."""
    passed = coerce(raw, spec).filter(_complete(spec) & _in_domain(spec))
    first = W.partitionBy("_source_file", spec.key).orderBy("_row")
    return passed.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") == 1).drop("_nth")


def file_report(raw: DataFrame, spec: FileSpec) -> DataFrame:
    """Per file: rows read, rows dropped by each rule in the order the rules apply, and rows kept.

    Counting by file and key first lets every task combine its rows before the shuffle, so neither a
    huge file nor a key that fills half of it lands in one task.
    """
    complete, known = _complete(spec), _in_domain(spec)
    per_key = (
        coerce(raw, spec)
        .groupBy("_source_file", spec.key)
        .agg(
            F.count(F.lit(1)).alias("read"),
            count_where(~complete).alias("incomplete"),
            count_where(complete & ~known).alias("unknown"),
            count_where(complete & known).alias("passed"),
        )
    )
    counted = per_key.groupBy("_source_file").agg(
        F.sum("read").alias("rows_read"),
        F.sum("incomplete").alias("null_required"),
        F.sum("unknown").alias("invalid_status"),
        F.sum(F.greatest(F.col("passed") - 1, F.lit(0))).alias("duplicates"),
        F.sum(F.least(F.col("passed"), F.lit(1))).alias("rows_kept"),
    )
    return counted.withColumnRenamed("_source_file", "source_file")


def report_messages(report: DataFrame) -> DataFrame:
    """:func:`file_report` with its counts as texts, one array per file; rules that dropped nothing say nothing."""
    # The texts
    noun = F.when(F.col("source_file").endswith("item_pedido.csv"), "items").otherwise("orders")
    said = F.array(
        F.when(F.col("null_required") > 0, F.format_string("Dropped %d rows with null required fields", "null_required")),
        F.when(F.col("invalid_status") > 0, F.format_string("Dropped %d rows with invalid Status", "invalid_status")),
        F.when(F.col("duplicates") > 0, F.format_string("Removed %d duplicate %s", F.col("duplicates"), noun)),
    )
    return report.withColumn("messages", F.array_compact(said))


def rejected_files(files: DataFrame, report: DataFrame) -> DataFrame:
    """Files without a single row that survived, whether or not any row was read from them."""
    kept = report.filter(F.col("rows_kept") > 0).select("source_file")
    return files.select("source_file").join(kept, "source_file", "left_anti").withColumn("error", F.lit(NO_VALID_ROWS))


def quarantine_report(rejected: DataFrame, as_of) -> DataFrame:
    """One JSON error report per rejected file, and where it belongs."""
    target = F.replace(F.col("source_file"), F.lit("raw/csv_sales/"), F.lit("quarantine/"))
    stamp = F.date_format(F.lit(as_of).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssxxx")
    report = F.to_json(
        F.struct("source_file", "error", stamp.alias("timestamp")),
    )
    return rejected.select(
        "source_file",
        "error",
        target.alias("quarantine_path"),
        F.regexp_replace(target, r"\.csv$", "_error.json").alias("report_path"),
        report.alias("report"),
    )


def missing_columns(header: Column, spec: FileSpec) -> Column:
    """Required header names that ``header``, an array of names, does not hold."""
    return F.array_except(F.array(*[F.lit(name) for name in spec.columns]), header)
