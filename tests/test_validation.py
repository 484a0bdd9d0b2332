"""Row validation: the three-row file and each way to spoil it."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators.validation import (
    coerce,
    file_report,
    quarantine_report,
    rejected_files,
    report_messages,
    valid_rows,
)
from tillflow.schemas import ITEMS_FILE, ORDERS_FILE

ORDERS = [
    ["1", "ORD001", "Loja Online", "2026-01-15", "42.90", "Rua A", "5.00", "Finalizado"],
    ["2", "ORD002", "Loja Fisica", "2026-01-15", "28.50", "Rua B", "0.00", "Pendente"],
    ["3", "ORD003", "Loja Online", "2026-01-16", "100.00", "Rua C", "8.50", "Cancelado"],
]
ITEMS = [
    ["ORD001", "ITEM001", "1", "2", "28.90", "Sem gluten"],
    ["ORD001", "ITEM002", "5", "1", "18.50", ""],
    ["ORD002", "ITEM003", "10", "3", "21.90", "Extra proteina"],
]


def raw(spark, spec, cells, changes=(), file="raw/csv_sales/u1/pedido.csv"):
    cells = [list(row) for row in cells]
    for index, column, value in changes:
        cells[index][spec.columns.index(column)] = value
    schema = ", ".join(f"{name} string" for name in spec.columns) + ", _source_file string, _row long"
    return spark.createDataFrame([(*row, file, i) for i, row in enumerate(cells)], schema)


@pytest.mark.parametrize(
    ("changes", "kept", "message"),
    [
        ([], 3, []),
        ([(1, "Vlr_Pedido", None)], 2, ["Dropped 1 rows with null required fields"]),
        ([(1, "Vlr_Pedido", "not_a_number")], 2, ["Dropped 1 rows with null required fields"]),
        ([(0, "Data_Pedido", "invalid-date")], 2, ["Dropped 1 rows with null required fields"]),
        ([(0, "Id_Unidade", "x")], 2, ["Dropped 1 rows with null required fields"]),
        ([(2, "Status", "Entregue")], 2, ["Dropped 1 rows with invalid Status"]),
        ([(2, "Status", "finalizado")], 2, ["Dropped 1 rows with invalid Status"]),
        ([(1, "Id_Pedido", "ORD001")], 2, ["Removed 1 duplicate orders"]),
        ([(0, "Taxa_Entrega", "free")], 3, []),
        (
            [(0, "Status", None), (1, "Status", "?"), (2, "Id_Pedido", "ORD009")],
            1,
            ["Dropped 1 rows with null required fields", "Dropped 1 rows with invalid Status"],
        ),
    ],
)
def test_orders(spark, changes, kept, message):
    frame = raw(spark, ORDERS_FILE, ORDERS, changes)
    assert valid_rows(frame, ORDERS_FILE).count() == kept
    report = file_report(frame, ORDERS_FILE)
    assert rows(report, "rows_read", "rows_kept") == [(3, kept)]
    assert rows(report_messages(report), "messages") == [(message,)]


@pytest.mark.parametrize(
    ("changes", "kept"),
    [
        ([], 3),
        ([(0, "Qtd", None)], 2),
        ([(0, "Qtd", "two")], 2),
        ([(0, "Qtd", "2.0")], 3),
        ([(0, "Qtd", "2.5")], 2),
        ([(0, "Vlr_Item", "nan")], 2),
        ([(1, "Id_Item_Pedido", "ITEM001")], 2),
        ([(0, "Observacao", None)], 3),
    ],
)
def test_items(spark, changes, kept):
    frame = raw(spark, ITEMS_FILE, ITEMS, changes, "raw/csv_sales/u1/item_pedido.csv")
    assert valid_rows(frame, ITEMS_FILE).count() == kept
    assert rows(file_report(frame, ITEMS_FILE), "rows_kept") == [(kept,)]


def test_duplicate_items_are_named_items(spark):
    frame = raw(spark, ITEMS_FILE, ITEMS, [(1, "Id_Item_Pedido", "ITEM001")], "raw/csv_sales/u1/item_pedido.csv")
    assert rows(report_messages(file_report(frame, ITEMS_FILE)), "messages") == [(["Removed 1 duplicate items"],)]


def test_first_of_equal_keys_stays_and_filters_come_first(spark):
    frame = raw(spark, ORDERS_FILE, ORDERS, [(0, "Status", "?"), (1, "Id_Pedido", "ORD001"), (2, "Id_Pedido", "ORD001")])
    assert rows(valid_rows(frame, ORDERS_FILE), "Id_Unidade") == [(2,)]


def test_equal_keys_in_two_files_both_stay(spark):
    frame = raw(spark, ORDERS_FILE, ORDERS).unionByName(raw(spark, ORDERS_FILE, ORDERS, file="raw/csv_sales/u2/pedido.csv"))
    assert valid_rows(frame, ORDERS_FILE).count() == 6


def test_money_is_exact_and_rounds_half_up(spark):
    frame = raw(spark, ORDERS_FILE, ORDERS, [(0, "Vlr_Pedido", "1.005"), (1, "Vlr_Pedido", "1e2"), (2, "Vlr_Pedido", " 7.1 ")])
    found = [str(v) for (v,) in rows(coerce(frame, ORDERS_FILE).orderBy("_row"), "Vlr_Pedido")]
    assert found == ["1.01", "100.00", "7.10"]


def test_file_without_valid_rows_is_quarantined(spark):
    bad = raw(spark, ORDERS_FILE, ORDERS, [(i, "Status", "?") for i in range(3)], "raw/csv_sales/u2/pedido.csv")
    frame = raw(spark, ORDERS_FILE, ORDERS).unionByName(bad)
    files = spark.createDataFrame(
        [("raw/csv_sales/u1/pedido.csv",), ("raw/csv_sales/u2/pedido.csv",), ("raw/csv_sales/u3/pedido.csv",)],
        "source_file string",
    )
    rejected = rejected_files(files, file_report(frame, ORDERS_FILE))
    report = quarantine_report(rejected, "2026-02-01 00:00:00").orderBy("source_file")
    assert rows(report, "quarantine_path", "report_path") == [
        ("quarantine/u2/pedido.csv", "quarantine/u2/pedido_error.json"),
        ("quarantine/u3/pedido.csv", "quarantine/u3/pedido_error.json"),
    ]
    first = report.select(F.from_json("report", "source_file string, error string, timestamp string").alias("r")).first().r
    assert tuple(first) == ("raw/csv_sales/u2/pedido.csv", "No valid rows after validation", "2026-02-01T00:00:00+00:00")
