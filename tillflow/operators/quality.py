"""Data-quality checks. Every check gives a frame of one row per verdict with the same columns.

Thresholds are arguments; the defaults below are fixed values.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.filters import Filters
from tillflow.functions.numbers import count_where

EXPECTED_UNITS = 50
WARN_SHARE = 0.9
ACCURACY_PASS = 0.01
ACCURACY_WARN = 1.0
VOLUME_STD_DEVS = 2.0
MAX_NULL_RATE = 0.05
MAX_DUPLICATE_RATE = 0.01
EXPECTED_REFERENCE_ROWS = {"products": 30, "units": 50, "states": 27, "countries": 1}
SQL_LIMIT = 4000

# What each check computes, as SQL for the log. The checks themselves are DataFrame code.
CHECK_SQL = {
    "freshness": "SELECT count(*) FROM gold.fact_sales WHERE order_date = :execution_date",
    "completeness": "SELECT count(DISTINCT unit_key) FROM gold.fact_sales WHERE order_date = :execution_date",
    "accuracy": (
        "SELECT abs(i.total - s.total) FROM (SELECT sum(unit_price * quantity) AS total FROM silver.order_items) AS i, "
        "(SELECT sum(items_subtotal) AS total FROM gold.fact_sales) AS s"
    ),
    "uniqueness": "SELECT order_id FROM gold.fact_sales GROUP BY order_id HAVING count(*) > 1 ORDER BY order_id LIMIT 10",
    "referential": "SELECT count(*) FROM gold.fact_order_items LEFT ANTI JOIN gold.dim_product USING (product_key)",
    "volume": (
        "SELECT abs(max(n) FILTER (WHERE d = 0) - avg(n) FILTER (WHERE d > 0)) / nullif(stddev(n) FILTER (WHERE d > 0), 0) "
        "FROM (SELECT datediff(:execution_date, order_date) AS d, count(*) AS n FROM gold.fact_sales GROUP BY 1) WHERE d <= 30"
    ),
}

RESULT_COLUMNS = (
    "check_name",
    "check_category",
    "layer",
    "table_name",
    "check_sql",
    "result",
    "expected_value",
    "actual_value",
    "details",
)


def _verdict(
    measured: DataFrame,
    name: str,
    category: str,
    layer: str,
    table: str,
    sql: str,
    result: Column,
    expected: Column | str,
    actual: Column,
    details: Column | None = None,
) -> DataFrame:
    expected = F.lit(expected) if isinstance(expected, str) else expected
    return measured.select(
        F.lit(name).alias("check_name"),
        F.lit(category).alias("check_category"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        F.lit(sql).alias("check_sql"),
        result.alias("result"),
        expected.cast("string").alias("expected_value"),
        actual.cast("string").alias("actual_value"),
        (F.lit("{}") if details is None else F.to_json(details)).alias("details"),
    )


def _pass_or(condition: Column, otherwise: str) -> Column:
    return F.when(condition, "pass").otherwise(otherwise)


def freshness(sales: DataFrame, day: date) -> DataFrame:
    measured = Filters(day, day).dates(sales).agg(F.count(F.lit(1)).alias("n"))
    return _verdict(
        measured,
        "freshness_fact_sales",
        "freshness",
        "gold",
        "fact_sales",
        CHECK_SQL["freshness"],
        _pass_or(F.col("n") > 0, "fail"),
        ">0",
        F.col("n"),
        F.struct(F.lit(str(day)).alias("date_checked")),
    )


def completeness(sales: DataFrame, day: date, expected_units: int = EXPECTED_UNITS) -> DataFrame:
    measured = Filters(day, day).dates(sales).agg(F.count_distinct("unit_key").alias("n"))
    warn = F.when(F.col("n") >= expected_units * WARN_SHARE, "warn").otherwise("fail")
    return _verdict(
        measured,
        "completeness_all_units",
        "completeness",
        "gold",
        "fact_sales",
        CHECK_SQL["completeness"],
        F.when(F.col("n") >= expected_units, "pass").otherwise(warn),
        str(expected_units),
        F.col("n"),
        F.struct((F.lit(expected_units) - F.col("n")).alias("missing_units")),
    )


def accuracy(
    items: DataFrame, sales: DataFrame, tolerance: float = ACCURACY_PASS, warn_below: float = ACCURACY_WARN
) -> DataFrame:
    """Item values of silver against the item subtotals of gold. Nothing to compare on either side is a warning."""
    silver = items.agg(F.round(F.sum(F.col("unit_price") * F.col("quantity")), 2)).scalar()
    measured = sales.agg(F.round(F.sum("items_subtotal"), 2).cast("decimal(28,2)").alias("gold")).select(
        silver.cast("decimal(28,2)").alias("silver"), "gold"
    )
    zero = F.lit(0).cast("decimal(28,2)")
    diff = F.abs(F.coalesce("silver", zero) - F.coalesce("gold", zero))
    empty = F.col("silver").isNull() & F.col("gold").isNull()
    graded = F.when(diff < tolerance, "pass").when(diff < warn_below, "warn").otherwise("fail")
    return _verdict(
        measured,
        "accuracy_cross_layer_totals",
        "accuracy",
        "gold",
        "fact_sales",
        CHECK_SQL["accuracy"],
        F.when(empty, "warn").otherwise(graded),
        f"diff < {tolerance}",
        diff,
        F.struct(
            F.coalesce(F.col("silver").cast("string"), F.lit("N/A")).alias("silver_total"),
            F.coalesce(F.col("gold").cast("string"), F.lit("N/A")).alias("gold_total"),
        ),
    )


def uniqueness(sales: DataFrame, shown: int = 5) -> DataFrame:
    """Orders that occur more than once: counts all of them and shows the first ``shown``."""
    repeated = sales.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    first = repeated.orderBy("order_id").limit(shown).agg(F.sort_array(F.collect_list("order_id")).alias("ids"))
    measured = repeated.agg(F.count(F.lit(1)).alias("n")).withColumn("ids", first.scalar())
    return _verdict(
        measured,
        "uniqueness_order_id",
        "uniqueness",
        "gold",
        "fact_sales",
        CHECK_SQL["uniqueness"],
        _pass_or(F.col("n") == 0, "fail"),
        "0 duplicates",
        F.concat(F.col("n"), F.lit(" duplicates found")),
        F.struct(F.col("ids").alias("sample_duplicates")),
    )


def orphan_count(rows: DataFrame, key: str, known: DataFrame, known_key: str | None = None) -> DataFrame:
    """How many rows have a key that ``known`` lacks, nulls included; one row, column ``n``.

    Rows are counted per key before the join: the large side shrinks to its distinct keys, so a key held by
    a large share of the rows costs one row. The join is an outer one because Spark would push an anti join
    below the counting.
    """
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    there = known.select(F.col(known_key or key).alias(key)).distinct().withColumn("_known", F.lit(True))
    lost = F.sum(F.when(F.col("_known").isNull(), F.col("n")))
    return counted.join(there, key, "left").agg(F.coalesce(lost, F.lit(0)).alias("n"))


def referential(fact_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    measured = orphan_count(fact_items, "product_key", dim_product)
    return _verdict(
        measured,
        "referential_integrity_product",
        "referential",
        "gold",
        "fact_order_items",
        CHECK_SQL["referential"],
        _pass_or(F.col("n") == 0, "fail"),
        "0 orphans",
        F.concat(F.col("n"), F.lit(" orphan records")),
    )


def volume_anomaly(sales: DataFrame, day: date, threshold: float = VOLUME_STD_DEVS, days: int = 30) -> DataFrame:
    """Orders of the day against mean and sample deviation of the days with orders before it."""
    window = Filters(day - timedelta(days=days), day)
    per_day = window.dates(sales).groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))
    before, today = F.col("order_date") < F.lit(day), F.col("order_date") == F.lit(day)
    measured = per_day.agg(
        F.avg(F.when(before, F.col("n"))).alias("mean"),
        F.stddev_samp(F.when(before, F.col("n"))).alias("deviation"),
        F.max(F.when(today, F.col("n"))).alias("today"),
    ).withColumn("z", F.abs(F.col("today") - F.col("mean")) / F.nullif(F.col("deviation"), F.lit(0.0)))
    z = F.col("z")
    return _verdict(
        measured,
        "volume_anomaly_detection",
        "volume",
        "gold",
        "fact_sales",
        CHECK_SQL["volume"],
        _pass_or(F.coalesce(z <= threshold, F.lit(False)), "warn"),
        f"z_score <= {threshold}",
        F.when(z.isNull(), "insufficient data").otherwise(F.format_string("z_score = %.2f", z)),
        F.struct(
            F.coalesce(F.round("mean", 4).cast("string"), F.lit("N/A")).alias("avg_orders"),
            F.coalesce(F.col("today").cast("string"), F.lit("N/A")).alias("today_orders"),
        ),
    )


Checks = dict[str, Callable[[], DataFrame]]


def standard_checks(
    silver_items: DataFrame,
    sales: DataFrame,
    fact_items: DataFrame,
    dim_product: DataFrame,
    day: date,
    expected_units: int = EXPECTED_UNITS,
    threshold: float = VOLUME_STD_DEVS,
    tolerance: float = ACCURACY_PASS,
) -> Checks:
    """The six checks of a daily run, by function name, ready to be run one by one or as one union."""
    return {
        "check_freshness": lambda: freshness(sales, day),
        "check_completeness": lambda: completeness(sales, day, expected_units),
        "check_accuracy": lambda: accuracy(silver_items, sales, tolerance),
        "check_uniqueness": lambda: uniqueness(sales),
        "check_referential_integrity": lambda: referential(fact_items, dim_product),
        "check_volume_anomaly": lambda: volume_anomaly(sales, day, threshold),
    }


def union_checks(checks: Checks) -> DataFrame:
    frames = [check() for check in checks.values()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


_RUN_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in RESULT_COLUMNS] + [T.StructField("duration_seconds", T.DoubleType())]
)


def run_checks(spark: SparkSession, checks: Checks) -> DataFrame:
    """Run each check once. A check that raises becomes a failed row and does not stop the others."""
    rows = []
    for name, check in checks.items():
        started = time.monotonic()
        try:
            found = [tuple(row[column] for column in RESULT_COLUMNS) for row in check().collect()]
        except Exception as error:  # noqa: BLE001 - any failure of a check is its result
            found = [(name, "error", "unknown", "", "", "fail", "no error", str(error), "{}")]
        took = round(time.monotonic() - started, 2)
        rows += [(*row, took) for row in found]
    return spark.createDataFrame(rows, _RUN_SCHEMA)


def boolean_check(
    spark: SparkSession,
    name: str,
    category: str,
    sql: str,
    expected: bool = True,
    layer: str = "gold",
    table: str = "",
    args: dict | None = None,
    **frames: DataFrame,
) -> DataFrame:
    """Any SQL whose first cell is true or false; no row counts as false. Frames are named in braces in the SQL."""
    answer = spark.sql(sql, args=args, **frames)
    # the aggregate turns "no row" into a row; the query gives one row, so the limit only guards the first cell
    first = answer.select(F.col(f"`{answer.columns[0]}`").cast("boolean").alias("cell")).limit(1)
    measured = first.agg(F.coalesce(F.max("cell"), F.lit(False)).alias("cell"))
    result = _pass_or(F.col("cell") == F.lit(expected), "fail")
    return _verdict(measured, name, category, layer, table, sql, result, str(expected), result)


def freshness_gate(rows: DataFrame, target: date, column: str = "order_date", minimum: int = 1) -> DataFrame:
    """Whether at least ``minimum`` rows carry the date."""
    measured = Filters(target, target).dates(rows, column).agg(F.count(F.lit(1)).alias("row_count"))
    return measured.withColumn("ready", F.col("row_count") >= minimum)


def _gates(measured: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """One row per gate out of a one-row frame."""
    pairs = [F.struct(F.lit(name).alias("check_name"), gate.alias("passed")) for name, gate in gates.items()]
    return measured.select(F.inline(F.array(*pairs)))


def silver_gate(orders: DataFrame, items: DataFrame) -> DataFrame:
    item_count = items.agg(F.count(F.lit(1))).scalar()
    measured = orders.agg(
        F.count(F.lit(1)).alias("orders"), count_where(F.col("order_id").isNull()).alias("null_ids")
    ).withColumn("items", item_count)
    return _gates(
        measured,
        {
            "orders_not_empty": F.col("orders") > 0,
            "order_items_not_empty": F.col("items") > 0,
            "no_null_order_ids": F.col("null_ids") == 0,
        },
    )


def gold_gate(sales: DataFrame, dim_product: DataFrame, dim_unit: DataFrame) -> DataFrame:
    """One pass over the fact: it is counted per unit, and the units are then looked up in the dimension."""
    products = dim_product.agg(F.count(F.lit(1))).scalar()
    per_unit = sales.groupBy("unit_key").agg(F.count(F.lit(1)).alias("n"))
    known = dim_unit.select(F.col("unit_key"), F.lit(True).alias("known"))
    measured = (
        per_unit.join(known, "unit_key", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("sales"),
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
        )
        .withColumn("products", products)
    )
    return _gates(
        measured,
        {
            "fact_sales_not_empty": F.col("sales") > 0,
            "dims_populated": F.col("products") > 0,
            "no_orphan_units": F.col("orphans") == 0,
        },
    )


def day_gate(sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """No sale on a day that the date dimension lacks; such sales would be in no mart."""
    return _gates(orphan_count(sales, "date_key", dim_date), {"days_covered": F.col("n") == 0})


def layer_gate(layers: dict[str, DataFrame]) -> DataFrame:
    """Whether each frame has a row; every side stops at its first row."""
    answers = [
        frame.limit(1).agg((F.count(F.lit(1)) > 0).alias("passed")).select(F.lit(name).alias("table_name"), "passed")
        for name, frame in layers.items()
    ]
    result = answers[0]
    for answer in answers[1:]:
        result = result.unionByName(answer)
    return result


def reference_checks(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """Row counts of the reference tables against the least expected, and units without a known state."""
    expected = EXPECTED_REFERENCE_ROWS if expected is None else expected
    found = None
    for name, least in expected.items():
        count = F.col("n")
        row = tables[name].agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(f"{name}_row_count").alias("check_name"),
            count.alias("actual"),
            F.lit(least).cast("long").alias("expected"),
            F.when(count >= least, "OK").otherwise("WARN").alias("status"),
        )
        found = row if found is None else found.unionByName(row)
    orphans = orphan_count(tables["units"], "id_estado", tables["states"]).select(
        F.lit("orphan_units").alias("check_name"),
        F.col("n").alias("actual"),
        F.lit(0).cast("long").alias("expected"),
        F.when(F.col("n") == 0, "OK").otherwise("WARN").alias("status"),
    )
    return orphans if found is None else found.unionByName(orphans)


def orphans(units: DataFrame, states: DataFrame, countries: DataFrame) -> DataFrame:
    """Units without a known state and states without a known country."""
    lost_units = units.join(states.select("id_estado"), "id_estado", "left_anti").select(
        F.lit("unit").alias("kind"), F.col("id_unidade").alias("id"), F.col("nome_unidade").alias("name")
    )
    lost_states = states.join(countries.select("id_pais"), "id_pais", "left_anti").select(
        F.lit("state").alias("kind"), F.col("id_estado").alias("id"), F.col("nome_estado").alias("name")
    )
    return lost_units.unionByName(lost_states)


def failures(results: DataFrame) -> DataFrame:
    return results.filter(F.col("result") == "fail")


def latest_results(log: DataFrame, limit: int = 10) -> DataFrame:
    newest = log.orderBy(F.desc("execution_timestamp"), "check_name").limit(limit)
    return newest.select("check_name", "result", "actual_value", "execution_timestamp")


def rates(
    rows: DataFrame,
    key: str,
    columns: Iterable[str],
    max_null: float = MAX_NULL_RATE,
    max_duplicate: float = MAX_DUPLICATE_RATE,
) -> DataFrame:
    """Share of null cells over the given columns and share of rows that repeat a key, with verdicts.

    Rows are combined per key first; the key itself counts as a cell like the others when it is listed.
    """
    columns = list(columns)
    nulls = sum((F.col(name).isNull().cast("long") for name in columns), F.lit(0).cast("long"))
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(nulls).alias("nulls"))
    measured = per_key.agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.count(key).alias("keys")
    )
    n = F.nullif(F.col("n"), F.lit(0))
    shares = measured.select(
        (F.col("nulls") / (n * len(columns))).alias("null_rate"),
        (F.lit(1) - F.col("keys") / n).alias("duplicate_rate"),
    )
    limits = {"null_rate": max_null, "duplicate_rate": max_duplicate}
    pairs = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.round(name, 6).alias("rate"),
            F.when(F.col(name) > limit, "fail").otherwise("pass").alias("result"),
        )
        for name, limit in limits.items()
    ]
    return shares.select(F.inline(F.array(*pairs)))


def bronze_age(rows: DataFrame, as_of, stale_hours: int = 24) -> DataFrame:
    """Newest ingest time, its age in whole hours, and whether what is built from it counts as stale."""
    newest = rows.agg(F.max("_ingest_timestamp").alias("latest_ingest"))
    seconds = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("latest_ingest")
    hours = F.floor(seconds / 3600)
    return newest.select("latest_ingest", hours.alias("age_hours"), (seconds > stale_hours * 3600).alias("stale"))


def files_arrived(files: DataFrame, prefix: str) -> DataFrame:
    """Whether any file lies under the prefix."""
    some = files.filter(F.col("path").contains(prefix)).limit(1)
    return some.agg((F.count(F.lit(1)) > 0).alias("ready"))


def log_rows(results: DataFrame, day: date, run_id: str = "", as_of=None) -> DataFrame:
    """Check results as rows of the quality log: a short random id, the SQL cut to its limit."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    took = F.col("duration_seconds") if "duration_seconds" in results.columns else F.lit(0.0)
    return results.select(
        F.substring(F.uuid(), 1, 12).alias("check_id"),
        "check_name",
        "check_category",
        "layer",
        "table_name",
        F.left("check_sql", F.lit(SQL_LIMIT)).alias("check_sql"),
        "result",
        "expected_value",
        "actual_value",
        "details",
        F.lit(day).alias("execution_date"),
        now.alias("execution_timestamp"),
        F.lit(run_id).alias("dag_run_id"),
        took.alias("duration_seconds"),
    )
