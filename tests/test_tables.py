"""Replacing tables: a write that fails leaves what was there."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.schemas import REFERENCE_SPECS
from tillflow.sources.reference import extract_reference, load_reference
from tillflow.sources.tables import TableStore, create_tables, replace_folder


def broken(kind="bigint"):
    return F.raise_error(F.lit("broken")).cast(kind)


def test_a_failed_replacement_leaves_the_table(spark, store):
    store.write("gold.t", spark.range(3))
    with pytest.raises(Exception, match="broken"):
        store.write("gold.t", spark.range(9).select(F.when(F.col("id") == 8, broken()).otherwise(F.col("id")).alias("id")))
    assert store.read("gold.t").count() == 3


def test_readers_keep_the_version_they_hold(spark, store):
    store.write("gold.t", spark.range(3))
    held = store.read("gold.t")
    store.write("gold.t", spark.range(4))
    assert (held.count(), store.read("gold.t").count()) == (3, 4)
    for _ in range(3):
        store.write("gold.t", spark.range(5))
    assert len([n for n in os.listdir(f"{store.root}/gold/t") if n.startswith("_batch=")]) == 2
    store.append("gold.t", spark.range(1))
    assert store.read("gold.t").count() == 6


def test_a_bad_reference_file_leaves_its_table(spark, store, tmp_path):
    for spec in REFERENCE_SPECS:
        names = list(spec.renames)
        (tmp_path / spec.file_name).write_text(";".join(names) + "\n" + ";".join("1" for _ in names) + "\n", encoding="utf-8")
    load_reference(spark, str(tmp_path), store)
    bad = next(spec for spec in REFERENCE_SPECS if spec.table == "units")
    (tmp_path / bad.file_name).write_text("Wrong;Header\n1;2\n", encoding="utf-8")
    status = dict(rows(load_reference(spark, str(tmp_path), store), "table_name", "status"))
    assert status["units"].startswith("error") and status["products"] == "loaded"
    assert store.read("bronze.units").count() == 1


def test_a_failed_extract_leaves_the_file(spark, tmp_path):
    def read(fails: bool):
        def one(spec):
            cells = [F.col("id").cast("string").alias(name) for name in spec.renames.values()]
            return spark.range(2, numPartitions=1).select(*(F.when(F.col("id") == 1, broken("string")).otherwise(c).alias(n) if fails else c for c, n in zip(cells, spec.renames.values(), strict=True)))

        return one

    target = str(tmp_path / "out")
    extract_reference(spark, read(False), target, waits=(0,))
    with pytest.raises(Exception, match="broken"):
        extract_reference(spark, read(True), target, waits=(0,))
    folder = f"{target}/{REFERENCE_SPECS[0].file_name}"
    assert spark.read.option("header", True).csv(folder).count() == 2


def test_replacing_a_folder(spark, tmp_path):
    for name in ("new", "old"):
        (tmp_path / name).mkdir()
        (tmp_path / name / name).write_text("x", encoding="utf-8")
    replace_folder(spark, str(tmp_path / "new"), str(tmp_path / "old"))
    assert os.listdir(tmp_path / "old") == ["new"] and os.listdir(tmp_path) == ["old"]


def test_a_transaction_is_all_or_nothing(spark, store):
    store.append("a.x", spark.range(2))
    with pytest.raises(RuntimeError, match="between"), store.transaction(("job", 1)) as changes:
        changes.append("a.x", spark.range(5))
        changes.append("a.y", spark.range(5))
        raise RuntimeError("between")
    assert store.read("a.x").count() == 2 and not store.exists("a.y") and not store.committed(("job", 1))
    with pytest.raises(Exception, match="broken"), store.transaction(("job", 1)) as changes:
        changes.append("a.x", spark.range(5))
        changes.append("a.y", spark.range(9).select(F.when(F.col("id") == 8, broken()).otherwise(F.col("id")).alias("id")))
    assert store.read("a.x").count() == 2
    with store.transaction(("job", 1)) as changes:
        changes.append("a.x", spark.range(5))
        changes.append("a.y", spark.range(5))
    assert (store.read("a.x").count(), store.read("a.y").count()) == (7, 5)
    assert store.committed(("job", 1)) and store.committed(("job", 0)) and not store.committed(("job", 2))


def test_what_a_killed_load_left_is_not_read_and_is_replaced(spark, store):
    store.append("a.x", spark.range(2))
    killed = store.transaction(("job", 7))
    killed.__enter__().append("a.x", spark.range(50))  # and the process ends here
    del killed
    assert TableStore(spark, store.root).read("a.x").count() == 2
    with store.transaction(("job", 7)) as changes:
        changes.append("a.x", spark.range(3))
    assert store.read("a.x").count() == 5


def test_two_writers_of_one_batch(spark, store):
    other = TableStore(spark, store.root)
    with pytest.raises(RuntimeError, match="another writer"), store.transaction(("job", 1)) as mine:
        mine.append("a.x", spark.range(1))
        with other.transaction(("job", 1)) as theirs:
            theirs.append("a.z", spark.range(1))
    assert not store.exists("a.x") and store.exists("a.z")


def test_writers_take_turns_and_snapshots_keep_the_state(spark, store):
    other = TableStore(spark, store.root)
    for i in range(23):
        (store if i % 2 else other).append("a.x", spark.range(1))
    assert any(n.endswith(".snapshot") for n in os.listdir(f"{store.root}/_log"))
    fresh = TableStore(spark, store.root)
    assert fresh.read("a.x").count() == 23 and fresh.state() == store.state() == other.state()


def test_partitions_are_replaced_and_dropped(spark, store):
    def days(*cells):
        return spark.createDataFrame(cells, "v long, day date")

    one, two, three = date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)
    store.write("a.x", days((1, one), (2, two), (3, two)), "day")
    version = store.state()[0]
    store.append("a.x", days((4, two), (5, three)), "day")
    assert sorted(rows(store.read_since("a.x", version), "v")) == [(4,), (5,)]
    with store.transaction() as changes:
        changes.replace_partitions("a.x", days((9, two)), "day", ["2026-01-02"])
    assert sorted(rows(store.read("a.x"), "v")) == [(1,), (5,), (9,)]
    assert store.drop_partitions_before("a.x", "day", two) == ["2026-01-01"]
    assert sorted(rows(store.read("a.x"), "v")) == [(5,), (9,)]
    store.append("a.x", days((6, None)), "day")
    assert sorted(rows(store.read("a.x"), "v", "day"), key=str) == [(5, three), (6, None), (9, two)]


def test_other_columns_are_refused(spark, store):
    store.append("a.x", spark.range(1))
    with pytest.raises(ValueError, match="columns of a.x"):
        store.append("a.x", spark.range(1).withColumn("more", F.lit(1)))
    assert store.read("a.x").count() == 1


def test_a_table_without_rows_has_its_columns(spark, store):
    store.append("a.x", spark.range(0).withColumn("day", F.current_date()), "day")
    assert store.read("a.x").columns == ["id", "day"] and store.read("a.x").count() == 0


def test_the_catalog_follows_the_store(spark, store, bronze_orders):
    create_tables(spark, store.root, "follow_")

    def counts(name):
        return spark.sql(f"SELECT count(*) FROM follow_{name}").first()[0], store.read(name).count()

    orders = bronze_orders({"id_pedido": "A"}, {"id_pedido": "B", "_ingest_date": date(2026, 1, 17)})
    store.append("bronze.orders", orders, "_ingest_date")
    products = spark.createDataFrame([(1, "p", datetime(2026, 1, 1))], "id_produto long, nome_produto string, _ingest_timestamp timestamp")
    store.write("bronze.products", products)
    assert counts("bronze.orders") == (2, 2) and counts("bronze.products") == (1, 1)
    store.append("bronze.orders", orders, "_ingest_date")
    store.write("bronze.products", products.union(products))
    assert counts("bronze.orders") == (4, 4) and counts("bronze.products") == (2, 2)
    with pytest.raises(RuntimeError), store.transaction() as changes:
        changes.append("bronze.orders", orders, "_ingest_date")
        raise RuntimeError
    assert counts("bronze.orders") == (4, 4)
    store.drop_partitions_before("bronze.orders", "_ingest_date", date(2026, 1, 17))
    assert counts("bronze.orders") == (2, 2)
    spark.sql("DROP TABLE follow_bronze.orders")
    create_tables(spark, store.root, "follow_")
    assert counts("bronze.orders") == (2, 2)
    day = spark.sql("SELECT id_pedido FROM follow_bronze.orders WHERE _ingest_date = DATE '2026-01-17'")
    assert sorted(rows(day)) == [("B",), ("B",)]
