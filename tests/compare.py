"""Run a registered query and its oracle over the same tables and tell where they differ.

As a script: ``python tests/compare.py FOLDER [query ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    """Kinds stay apart: a number never equals a text, a date never equals a timestamp. NaN equals NaN."""
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", "nan" if value != value else repr(value + 0.0))
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return ("timestamp", value.replace(tzinfo=None).isoformat())
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    return ("null", "") if value is None else ("text", str(value))


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(found, con, sql: str) -> str | None:
    """None when the frame and the SQL give the same columns and rows; else what differs first."""
    expected = con.execute(sql)
    expected_names = [column[0] for column in expected.description]
    expected_rows = _rows(expected_names, expected.fetchall())
    if sorted(found.columns) != sorted(expected_names):
        return f"columns {sorted(set(found.columns) ^ set(expected_names))}"
    found_rows = _rows(found.columns, found.collect())
    if len(found_rows) != len(expected_rows):
        return f"{len(found_rows)} rows, expected {len(expected_rows)}"
    names = sorted(expected_names)
    for mine, theirs in zip(found_rows, expected_rows, strict=True):
        if mine != theirs:
            cells = [(n, a, b) for n, a, b in zip(names, mine, theirs, strict=True) if a != b]
            return f"{cells[:4]} in {mine}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import time

    import __spark_entry__ as contract
    from tillflow.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    folder, wanted = sys.argv[1], sys.argv[2:]
    con, bad = connect(folder), 0
    oracles = contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.monotonic()
        try:
            frame = query(spark, folder)
            problem = difference(frame, con, oracles[name]) if name in oracles else f"no oracle, {frame.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"raised {str(error)[:300]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.monotonic() - started:.2f}s {problem or ''}")
    print(f"{bad} differ")
