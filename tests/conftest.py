from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tillflow.schemas import BRONZE  # noqa: E402
from tillflow.session import build_session  # noqa: E402

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from tillflow.sources.tables import TableStore

    return TableStore(spark, str(tmp_path / "tables"))


@pytest.fixture
def bronze_orders(spark):
    """Make bronze orders out of dicts; what is left out has a plain value."""

    def make(*rows: dict):
        plain = {
            "id_unidade": 1,
            "tipo_pedido": "Loja Online",
            "data_pedido": date(2026, 1, 15),
            "vlr_pedido": "42.90",
            "endereco_entrega": "Rua A",
            "taxa_entrega": "5.00",
            "status": "Finalizado",
            "_source_file": "raw/csv_sales/a/pedido.csv",
            "_ingest_timestamp": datetime(2026, 1, 16),
            "_ingest_date": date(2026, 1, 16),
        }
        return _frame(spark, "orders", [plain | row for row in rows])

    return make


@pytest.fixture
def bronze_items(spark):
    def make(*rows: dict):
        plain = {
            "id_pedido": "O1",
            "id_produto": 1,
            "qtd": 2,
            "vlr_item": "10.00",
            "observacao": None,
            "_source_file": "raw/csv_sales/a/item_pedido.csv",
            "_ingest_timestamp": datetime(2026, 1, 16),
            "_ingest_date": date(2026, 1, 16),
        }
        return _frame(spark, "order_items", [plain | row for row in rows])

    return make


def _frame(spark, table: str, rows: list[dict]):
    from decimal import Decimal

    schema = BRONZE[table]
    money = {f.name for f in schema if f.dataType.typeName() == "decimal"}
    cells = [
        tuple(Decimal(row[n]) if n in money and row[n] is not None else row[n] for n in schema.names) for row in rows
    ]
    return spark.createDataFrame(cells, schema)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().toString()


def executed_plan(frame) -> str:
    """The plan after AQE is done with it."""
    query = frame._jdf.queryExecution()
    frame._jdf.queryExecution().executedPlan().execute().count()
    return query.executedPlan().toString()


def rows(frame, *columns) -> list[tuple]:
    return [tuple(r) for r in (frame.select(*columns) if columns else frame).collect()]
