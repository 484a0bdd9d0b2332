"""Landing files on disk: routing, headers, broken files, and what goes to quarantine."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators.bronze import to_bronze
from tillflow.plans import queries
from tillflow.schemas import BRONZE, ITEMS_FILE, ORDERS_FILE
from tillflow.sources import bench, landing

HEADER = "Id_Unidade;Id_Pedido;Tipo_Pedido;Data_Pedido;Vlr_Pedido;Endereco_Entrega;Taxa_Entrega;Status"
LINE = "1;{};Loja Online;2026-01-15;42.90;Rua A;5.00;Finalizado"


@pytest.fixture
def drop(tmp_path):
    base = tmp_path / "raw" / "csv_sales"

    def write(unit: str, *lines: str, name: str = "pedido.csv") -> str:
        folder = base / unit
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
        return str(base)

    base.mkdir(parents=True)
    return write


def errors(found) -> dict[str, str]:
    return {r.source_file.split("/")[-2]: r.error for r in found.rejected.collect()}


def test_valid_rows_become_bronze_rows(spark, drop):
    path = drop("u1", HEADER, LINE.format("A"), LINE.format("B"))
    found = landing.scan(spark, path, ORDERS_FILE)
    loaded = to_bronze(found.valid, ORDERS_FILE, datetime(2026, 1, 16, 3))
    assert loaded.schema.names == BRONZE["orders"].names
    assert [f.dataType for f in loaded.schema] == [f.dataType for f in BRONZE["orders"]]
    assert rows(loaded.orderBy("id_pedido"), "id_pedido", "_source_file", F.col("_ingest_date").cast("string")) == [
        ("A", "raw/csv_sales/u1/pedido.csv", "2026-01-16"),
        ("B", "raw/csv_sales/u1/pedido.csv", "2026-01-16"),
    ]
    assert errors(found) == {}


def test_other_files_are_ignored(spark, drop):
    drop("u1", HEADER, LINE.format("A"))
    drop("u1", "Id_Pedido;Id_Item_Pedido;Id_Produto;Qtd;Vlr_Item;Observacao", "A;I1;1;2;3.00;", name="item_pedido.csv")
    drop("u1", "junk", name="notes.csv")
    path = drop("u1", HEADER, LINE.format("Z"), name="pedido.txt")
    assert rows(landing.scan(spark, path, ORDERS_FILE).valid, "Id_Pedido") == [("A",)]
    assert rows(landing.scan(spark, path, ITEMS_FILE).valid, "Id_Item_Pedido", "Observacao") == [("I1", None)]


def test_columns_are_found_by_name_and_extra_ones_dropped(spark, drop):
    path = drop("u1", "Status;Extra;" + HEADER.removesuffix(";Status"), "Pendente;x;" + LINE.format("A").removesuffix(";Finalizado"))
    found = landing.scan(spark, path, ORDERS_FILE)
    assert rows(found.valid, "Id_Pedido", "Status", "Endereco_Entrega") == [("A", "Pendente", "Rua A")]


def test_quotes_line_breaks_and_short_lines(spark, drop):
    path = drop(
        "u1", HEADER, '1;A;Loja Online;2026-01-15;42.90;"Rua ""A""; 1\nfundos";5.00;Finalizado', "1;B;Loja Online;2026-01-15;1.00"
    )
    found = landing.scan(spark, path, ORDERS_FILE)
    assert rows(found.valid, "Endereco_Entrega") == [('Rua "A"; 1\nfundos',)]
    assert rows(found.report, "rows_read", "null_required") == [(2, 1)]


def test_rejected_files_and_reasons(spark, drop):
    drop("good", HEADER, LINE.format("A"))
    drop("no_status", HEADER.removesuffix(";Status"), LINE.format("B"))
    drop("only_header", HEADER)
    drop("too_wide", HEADER, LINE.format("C") + ";surplus")
    drop("all_bad", HEADER, LINE.format("D").replace("Finalizado", "?"))
    path = drop("big", HEADER, *[LINE.format(f"E{i}") for i in range(50)])
    found = landing.scan(spark, path, ORDERS_FILE, max_bytes=2000)
    assert rows(found.valid, "Id_Pedido") == [("A",)]
    nothing = "No valid rows after validation"
    said = errors(found)
    assert said.pop("big").startswith("File exceeds 0MB limit (")
    assert said == {
        "no_status": landing.PROCESSING_FAILED,  # its line is wider than its header
        "only_header": nothing,
        "too_wide": landing.PROCESSING_FAILED,
        "all_bad": nothing,
    }


def test_missing_column_rejects_the_file(spark, drop):
    path = drop("u1", HEADER.removesuffix(";Status"), LINE.format("B").removesuffix(";Finalizado"))
    assert errors(landing.scan(spark, path, ORDERS_FILE)) == {"u1": "No valid rows after validation"}


def test_size_limit_prunes_the_listing(spark, drop):
    drop("u1", HEADER, LINE.format("A"))
    path = drop("u2", HEADER, *[LINE.format(f"E{i}") for i in range(50)])
    texts = landing.read_texts(spark, path, ORDERS_FILE, max_bytes=1000)
    assert {r.file.split("/")[-2] for r in texts.select("file").collect()} == {"u1"}


def test_inventory_and_routing(spark, drop):
    drop("u1", HEADER)
    drop("u1", "x", name="item_pedido.csv")
    path = drop("u1", "x", name="other.csv")
    files = landing.file_inventory(spark, path)
    routed = files.select(landing.route(F.col("path"), "raw/csv_sales/").alias("t"), F.col("length") > 0)
    assert sorted(rows(routed), key=str) == sorted([("orders", True), ("order_items", True), (None, True)], key=str)
    assert rows(files.select(landing.route(F.col("path"), "raw/other/").alias("t")).distinct()) == [(None,)]


def test_quarantine_keeps_the_lines(spark, drop):
    drop("good", HEADER, LINE.format("A"))
    path = drop("bad", HEADER, LINE.format("D").replace("Finalizado", "?"), "tail")
    found = landing.scan(spark, path, ORDERS_FILE)
    kept = landing.quarantine_lines(found.rejected).orderBy("line_position")
    assert rows(kept, "line") == [(HEADER,), (LINE.format("D").replace("Finalizado", "?"),), ("tail",)]


def test_load_appends_and_quarantines(spark, store, drop):
    drop("good", HEADER, LINE.format("A"))
    path = drop("bad", HEADER, LINE.format("D").replace("Finalizado", "?"))
    for _ in range(2):
        landing.load(spark, path, ORDERS_FILE, store, as_of=datetime(2026, 1, 16))
    assert rows(store.read("bronze.orders"), "id_pedido") == [("A",), ("A",)]
    reports = store.read("quarantine.reports").drop("_report_date")
    assert rows(reports.distinct(), "source_file", "report_path") == [
        ("raw/csv_sales/bad/pedido.csv", "quarantine/bad/pedido_error.json")
    ]
    assert store.read("quarantine.lines").count() == 4


@pytest.mark.parametrize("extra", [33, 200, 2000])
def test_any_number_of_columns(spark, drop, extra):
    names = ";".join(f"X{i}" for i in range(extra))
    path = drop("u1", f"{names};{HEADER}", ";" * extra + LINE.format("A"))
    drop("too_wide", f"{names};{HEADER}", ";" * extra + LINE.format("B") + ";surplus")
    found = landing.scan(spark, path, ORDERS_FILE)
    assert rows(found.valid, "Id_Pedido", "Status") == [("A", "Finalizado")]
    assert errors(found) == {"too_wide": landing.PROCESSING_FAILED}


def test_odd_folder_names(spark, drop):
    path = drop("u 1%é", HEADER, LINE.format("A"))
    found = landing.scan(spark, path, ORDERS_FILE)
    assert rows(found.valid, "Id_Pedido") == [("A",)] and errors(found) == {}


def test_unnamed_columns_count(spark, drop):
    middle = HEADER.replace("Tipo_Pedido;", "Tipo_Pedido;;")
    path = drop("middle", middle, LINE.format("A").replace("Loja Online;", "Loja Online;;"))
    drop("end", HEADER + ";", LINE.format("B") + ";x")
    assert sorted(rows(landing.scan(spark, path, ORDERS_FILE).valid, "Id_Pedido", "Status")) == [("A", "Finalizado"), ("B", "Finalizado")]


def test_empty_files_are_rejected_and_listed(spark, store, drop):
    path = drop("u1", HEADER, LINE.format("A"))
    drop("empty")
    assert errors(landing.scan(spark, path, ORDERS_FILE)) == {"empty": "No valid rows after validation"}
    assert sorted(r.length == 0 for r in landing.file_inventory(spark, path).collect()) == [False, True]


def test_files_with_one_tail_stay_apart(spark, drop, tmp_path):
    drop("u1", HEADER, LINE.format("A"), LINE.format("B"))
    other = tmp_path / "copy" / "raw" / "csv_sales" / "u1"
    other.mkdir(parents=True)
    (other / "pedido.csv").write_text(f"{HEADER}\n{LINE.format('A')}\n", encoding="utf-8")
    found = landing.scan(spark, str(tmp_path), ORDERS_FILE)
    assert sorted(rows(found.valid, "Id_Pedido")) == [("A",), ("A",), ("B",)]
    assert {r[0] for r in rows(found.valid, "_source_file")} == {"raw/csv_sales/u1/pedido.csv"}


def test_files_outside_the_prefix_are_ignored(spark, drop, tmp_path):
    drop("u1", HEADER, LINE.format("A"))
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "pedido.csv").write_text(f"{HEADER}\n{LINE.format('Z')}\n", encoding="utf-8")
    assert rows(landing.scan(spark, str(tmp_path), ORDERS_FILE).valid, "Id_Pedido") == [("A",)]


def test_timestamps_give_their_day_and_odd_lines(spark, drop):
    path = drop(
        "u1", HEADER, LINE.format("A").replace("2026-01-15", "2026-01-15 10:00:00"), "", LINE.format("B").replace("2026-01-15", "2026-01-15T23:59:59") + "\r",
        LINE.format("C").replace("Rua A", 'Rua "A'),
    )
    found = landing.scan(spark, path, ORDERS_FILE)
    assert sorted(rows(found.valid, "Id_Pedido", F.col("Data_Pedido").cast("string"), "Endereco_Entrega")) == [
        ("A", "2026-01-15", "Rua A"),
        ("B", "2026-01-15", "Rua A"),
        ("C", "2026-01-15", 'Rua "A'),
    ]


def test_a_month_above_the_size_limit_is_dealt_to_several_files(spark, monkeypatch):
    cells = {
        "Id_Unidade": "1", "Tipo_Pedido": "'Loja Online'", "Data_Pedido": "'1997-03-04'", "Vlr_Pedido": "'10.00'", "Taxa_Entrega": "'1.00'",
        "Status": "'Finalizado'", "Id_Pedido": "id div 2", "Endereco_Entrega": "repeat('x', 200)", "_source_file": "'raw/csv_sales/1997/03/pedido.csv'",
    }

    def raw(n):
        return spark.range(n).selectExpr(*[f"CAST({sql} AS STRING) AS {name}" for name, sql in cells.items()], "id AS _row")

    whole = bench.landing_texts(raw(50_000), ORDERS_FILE).agg(F.max(F.octet_length("value")), F.sum(F.octet_length("value"))).first()
    assert whole[0] < landing.MAX_FILE_BYTES / 2 < landing.MAX_FILE_BYTES < whole[1]
    monkeypatch.setattr(bench, "PART_ROWS", 50)
    found = queries._landed(ORDERS_FILE, lambda spark, folder: raw(400))(spark, "no folder")
    assert [tuple(r) for r in found.groupBy("source_file").agg(F.count("*"), F.countDistinct("Id_Pedido")).collect()] == [
        ("raw/csv_sales/1997/03/pedido.csv", 200, 200)
    ]


def test_records_of_every_shape(spark, drop):
    """Quotes with text behind them, missing ends, spaces after quotes, short and empty records, blank lines of all kinds."""
    odd = ["", "   ", "\r", '"A";I1;1;2;3.00;"x;""y""\nz"', '"B"b;I2;1;2;3.00;', '"C"  ;I3;1;2;3.00;"last"\r', "D;I4;1;2;3.00", ";;;;;", 'E;I5;1;2;3.00;Rua "A']
    names = "Id_Pedido;Id_Item_Pedido;Id_Produto;Qtd;Vlr_Item;Observacao"
    path = drop("u1", names, *odd, name="item_pedido.csv")
    drop("blanks", "  ", "\r", names, *odd, name="item_pedido.csv")
    drop("returns", name="item_pedido.csv")
    with open(f"{path}/returns/item_pedido.csv", "w", encoding="utf-8", newline="") as file:
        file.write("\r".join([names, "A;I1;1;2;3.00;x", "B;I2;1;2;3.00;y"]))
    drop("endless", names, "A;I1;1;2;3.00;", 'B;"I2;1;2;3.00;', "C;I3;1;2;3.00;", name="item_pedido.csv")
    drop("endless_last", names, "A;I1;1;2;3.00;", 'B;I2;1;2;3.00;"x', "C;I3;1;2;3.00;", name="item_pedido.csv")
    drop("surplus", names, "A;I1;1;2;3.00;;", name="item_pedido.csv")
    found = landing.scan(spark, path, ITEMS_FILE)
    expected = [("A", "I1", 'x;"y"\nz'), ("Bb", "I2", None), ("C", "I3", "last"), ("D", "I4", None), ("E", "I5", 'Rua "A')]
    seen = {}
    for unit, *cells in rows(found.valid, F.split("_source_file", "/")[2], "Id_Pedido", "Id_Item_Pedido", "Observacao"):
        seen.setdefault(unit, []).append(tuple(cells))
    assert {u: sorted(c) for u, c in seen.items()} == {"u1": expected, "blanks": expected, "returns": [("A", "I1", "x"), ("B", "I2", "y")]}
    failed = landing.PROCESSING_FAILED
    assert errors(found) == {"endless": failed, "endless_last": failed, "surplus": failed}
    assert rows(found.report.filter("source_file LIKE '%u1%'"), "rows_read", "null_required") == [(6, 1)]


def test_very_wide_headers(spark, drop, monkeypatch):
    monkeypatch.setattr(landing, "WIDE", 10)
    names = ";".join(f"X{i}" for i in range(30))
    path = drop("u1", f"{HEADER};{names}", LINE.format("A") + ";" * 30, LINE.format("B"))
    drop("too_wide", f"{HEADER};{names}", LINE.format("C") + ";" * 31)
    drop("lacks_a_column", f"{names};{HEADER.removesuffix(';Status')}", "x")
    found = landing.scan(spark, path, ORDERS_FILE)
    assert sorted(rows(found.valid, "Id_Pedido", "Status")) == [("A", "Finalizado"), ("B", "Finalizado")]
    assert errors(found) == {"too_wide": landing.PROCESSING_FAILED, "lacks_a_column": "No valid rows after validation"}


def test_time_is_linear_in_a_file(spark, drop, tmp_path):
    """Twice the rows take at most 2.5 times as long, up to a file near the size limit."""
    import time

    def seconds(n):
        path = drop(f"n{n}/raw/csv_sales/u", HEADER, *[LINE.format(f"O{i}") for i in range(n)])
        folder = f"{path}/n{n}"
        best = []
        for _ in range(3):
            started = time.perf_counter()
            found = landing.scan(spark, folder, ORDERS_FILE)
            assert found.valid.count() == n
            best.append(time.perf_counter() - started)
        return min(best)

    seconds(1000)
    half, whole = seconds(85_000), seconds(170_000)  # 5 and 10 MB
    assert whole <= 2.5 * half and whole < 30


def test_lines_are_numbered_over_splits(spark, drop):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        path = drop("u1", *[f"line {i} " + "x" * (i % 50) for i in range(500)])
        drop("u2", "one", "two")
        files = [r[0] for r in landing.due_files(spark, path, ORDERS_FILE).select("source_file").collect()]
        found = rows(landing.lines_of(spark, files).orderBy("file", "line_position"), "line_position", "line")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == [(i, f"line {i} " + "x" * (i % 50)) for i in range(500)] + [(0, "one"), (1, "two")]
    assert landing.lines_of(spark, []).count() == 0


@pytest.mark.parametrize("fails_at", ["bronze.orders", "quarantine.reports", "quarantine.lines"])
def test_a_load_that_fails_between_its_tables_leaves_nothing(spark, store, drop, monkeypatch, fails_at):
    from tillflow.sources.tables import Transaction

    drop("good", HEADER, LINE.format("A"))
    path = drop("bad", HEADER, LINE.format("D").replace("Finalizado", "?"))
    append = Transaction.append

    def failing(self, name, *args, **options):
        append(self, name, *args, **options)
        if name == fails_at:
            raise RuntimeError("killed")

    batch = ("orders of 2026-01-15", 0)
    monkeypatch.setattr(Transaction, "append", failing)
    with pytest.raises(RuntimeError, match="killed"):
        landing.load(spark, path, ORDERS_FILE, store, as_of=datetime(2026, 1, 16), batch=batch)
    assert not store.exists("bronze.orders")
    monkeypatch.setattr(Transaction, "append", append)
    for first in (True, False, False):
        assert landing.load(spark, path, ORDERS_FILE, store, as_of=datetime(2026, 1, 16), batch=batch) is first
    assert rows(store.read("bronze.orders"), "id_pedido") == [("A",)]
    assert store.read("quarantine.reports").count() == 1 and store.read("quarantine.lines").count() == 2


def test_both_sides_of_a_load_are_written_at_the_same_time(spark, store, drop, monkeypatch):
    from threading import Barrier

    meet, bronze_rows, lines = Barrier(2, timeout=60), landing.to_bronze, landing.quarantine_lines

    def beside(step):
        def run(*args):
            meet.wait()
            return step(*args)

        return run

    monkeypatch.setattr(landing, "to_bronze", beside(bronze_rows))
    monkeypatch.setattr(landing, "quarantine_lines", beside(lines))
    drop("u1", HEADER, LINE.format("A"))
    path = drop("u2", HEADER, "1;B;Loja Online;never;42.90;Rua A;5.00;Finalizado")
    assert landing.load(spark, path, ORDERS_FILE, store)
    assert rows(store.read("bronze.orders"), "id_pedido") == [("A",)]
    assert rows(store.read("quarantine.reports"), "source_file") == [("raw/csv_sales/u2/pedido.csv",)]
    assert store.read("quarantine.lines").count() == 2
