from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_landing import HEADER, LINE, drop  # noqa: F401

from tillflow.operators import silver
from tillflow.operators.bronze import to_bronze
from tillflow.schemas import ITEMS_FILE, ORDERS_FILE
from tillflow.sources import landing
from tillflow.streaming import ingest, rollup

ITEM_HEADER = "Id_Pedido;Id_Item_Pedido;Id_Produto;Qtd;Vlr_Item;Observacao"
NOW = datetime(2026, 1, 16, 3)


def run(spark, path, store, checkpoint, spec=ORDERS_FILE, as_of=NOW):
    ingest.ingest_stream(spark, path, spec, store, str(checkpoint), as_of=as_of, files_per_batch=1).awaitTermination()


def test_stream_and_batch_give_the_same_bronze(spark, store, drop, tmp_path):  # noqa: F811
    drop("u1", HEADER, LINE.format("A"), LINE.format("A"), LINE.format("B").replace("42.90", "x"))
    path = drop("u2", "Status;" + HEADER.removesuffix(";Status"), "Pendente;" + LINE.format("C").removesuffix(";Finalizado"))
    run(spark, path, store, tmp_path / "cp")
    batch = to_bronze(landing.scan(spark, path, ORDERS_FILE).valid, ORDERS_FILE, NOW)
    streamed = store.read("bronze.orders").select(*batch.columns)
    assert sorted(rows(streamed)) == sorted(rows(batch))
    assert streamed.count() == 2


def test_new_files_are_taken_once(spark, store, drop, tmp_path):  # noqa: F811
    path = drop("u1", HEADER, LINE.format("A"))
    run(spark, path, store, tmp_path / "cp")
    run(spark, path, store, tmp_path / "cp")
    assert store.read("bronze.orders").count() == 1
    drop("u2", HEADER, LINE.format("B"))
    run(spark, path, store, tmp_path / "cp")
    assert sorted(rows(store.read("bronze.orders"), "id_pedido")) == [("A",), ("B",)]


def test_a_file_delivered_again_is_settled_in_silver(spark, store, drop, tmp_path):  # noqa: F811
    path = drop("u1", HEADER, LINE.format("A"))
    run(spark, path, store, tmp_path / "cp")
    once = rows(silver.silver_orders(store.read("bronze.orders")).drop("_source_file", "_ingest_timestamp", "_ingest_date"))
    drop("u1_again", HEADER, LINE.format("A"))
    run(spark, path, store, tmp_path / "cp", as_of=NOW + timedelta(hours=1))
    assert store.read("bronze.orders").count() == 2
    again = silver.silver_orders(store.read("bronze.orders"))
    assert rows(again.drop("_source_file", "_ingest_timestamp", "_ingest_date")) == once


def test_rejected_files_go_to_quarantine(spark, store, drop, tmp_path):  # noqa: F811
    drop("u1", HEADER, LINE.format("A"))
    path = drop("u2", HEADER, LINE.format("B").replace("Finalizado", "?"))
    run(spark, path, store, tmp_path / "cp")
    reports = store.read("quarantine.reports")
    assert rows(reports, "source_file", "error") == [("raw/csv_sales/u2/pedido.csv", "No valid rows after validation")]
    kept = store.read("quarantine.lines").orderBy("line_position")
    assert rows(kept, "line") == [(HEADER,), (LINE.format("B").replace("Finalizado", "?"),)]


def test_a_repeated_batch_changes_nothing_and_empty_cells_survive(spark, store, drop, tmp_path):  # noqa: F811
    drop("u1", HEADER, LINE.format("A"))
    bad = "1;D;;2026-01-15;42.90;;5.00;?"
    drop("empty")
    path = drop("u2", HEADER, bad)
    texts = landing.read_texts(spark, path, ORDERS_FILE)
    for _ in range(3):
        ingest.load_batch(texts, ORDERS_FILE, store, as_of=NOW, batch=("orders_x", 0))
    assert rows(store.read("bronze.orders"), "id_pedido") == [("A",)]
    reports = store.read("quarantine.reports")
    assert sorted(rows(reports, "source_file")) == [("raw/csv_sales/empty/pedido.csv",), ("raw/csv_sales/u2/pedido.csv",)]
    assert rows(store.read("quarantine.lines").orderBy("line_position"), "line") == [(HEADER,), (bad,)]


def test_a_batch_that_failed_half_way_is_done_again(spark, store, drop):  # noqa: F811
    drop("u2", HEADER, LINE.format("D").replace("Finalizado", "?"))
    path = drop("u1", HEADER, LINE.format("A"))
    texts = landing.read_texts(spark, path, ORDERS_FILE)
    killed = store.transaction(("orders_x", 1))
    killed.__enter__().append("bronze.orders", to_bronze(landing.scan(spark, path, ORDERS_FILE).valid, ORDERS_FILE, NOW), "_ingest_date")
    ingest.load_batch(texts, ORDERS_FILE, store, as_of=NOW, batch=("orders_x", 1))
    assert store.read("bronze.orders").count() == 1
    assert store.read("quarantine.lines").count() == 2


def test_a_batch_lists_the_days_of_its_files_only(spark, store, drop, tmp_path, monkeypatch):  # noqa: F811
    listed, whole = [], ingest.list_beside
    monkeypatch.setattr(ingest, "list_beside", lambda spark, folders, name: listed.extend(folders) or whole(spark, folders, name))
    drop("d2/empty")
    path = drop("d1/u1", HEADER, LINE.format("A"))
    run(spark, path, store, tmp_path / "cp")
    assert [folder.rpartition("/")[2] for folder in listed] == ["d1"] and store.read("quarantine.reports").count() == 0
    drop("d2/u1", HEADER, LINE.format("B"))
    drop("d2/u2", HEADER, LINE.format("C"))
    run(spark, path, store, tmp_path / "cp")
    assert rows(store.read("quarantine.reports"), "source_file") == [("raw/csv_sales/d2/empty/pedido.csv",)]


def test_size_limit_in_the_stream(spark, store, drop, tmp_path):  # noqa: F811
    drop("u1", HEADER, LINE.format("A"))
    path = drop("big", HEADER, *[LINE.format(f"E{i}") for i in range(50)])
    ingest.ingest_stream(spark, path, ORDERS_FILE, store, str(tmp_path / "cp"), as_of=NOW, max_bytes=2000).awaitTermination()
    assert rows(store.read("bronze.orders"), "id_pedido") == [("A",)]
    assert rows(store.read("quarantine.reports"), "source_file") == [("raw/csv_sales/big/pedido.csv",)]
    assert store.read("quarantine.lines").count() == 51


def test_items_may_come_before_their_order(spark, store, drop, tmp_path):  # noqa: F811
    path = drop("u1", ITEM_HEADER, "A;I1;1;2;3.00;", name="item_pedido.csv")
    run(spark, path, store, tmp_path / "cp_items", ITEMS_FILE)
    assert store.read("bronze.order_items").count() == 1
    drop("u1", HEADER, LINE.format("A"))
    run(spark, path, store, tmp_path / "cp_orders")
    orders = silver.silver_orders(store.read("bronze.orders"))
    assert silver.silver_order_items(store.read("bronze.order_items"), orders).count() == 1


@pytest.fixture
def events(spark, tmp_path):
    """A stream over Parquet files that are added one by one."""
    folder = tmp_path / "events"
    schema = "event_id long, ts timestamp, kind string, value long"

    def add(*cells: tuple):
        made = [(i, datetime(2026, 1, 1) + timedelta(minutes=m), "a", 1) for i, m in cells]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(str(folder))
        return spark.readStream.schema(schema).parquet(str(folder))

    return add


def test_windows_come_out_once_the_watermark_passed(spark, events, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def flow(stream):
        rollup.write_available(rollup.rollup_by_window(stream, "kind", "value"), out, checkpoint)
        found = spark.read.parquet(out).orderBy("window_start")
        return rows(found, "window_label", "event_count", "total")

    assert flow(events((1, 610), (2, 700), (3, 725))) == []  # 10:10, 11:40, 12:05
    assert flow(events((4, 860))) == [("window_1012", 2, 2)]  # 14:20: the watermark is 12:20
    assert flow(events((5, 630), (6, 1000))) == [("window_1012", 2, 2), ("window_1214", 1, 1)]  # 10:30 is too late


def test_redelivered_events_come_out_once(spark, events, tmp_path):
    stream = events((1, 0), (1, 0), (2, 5), (1, 0))
    rollup.write_available(rollup.drop_redelivered(stream, "event_id"), str(tmp_path / "out"), str(tmp_path / "cp"))
    stream = events((2, 5), (3, 6))
    rollup.write_available(rollup.drop_redelivered(stream, "event_id"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(rows(spark.read.parquet(str(tmp_path / "out")), "event_id")) == [(1,), (2,), (3,)]


def test_last_window_of_the_day_ends_at_zero(spark):
    label = rollup.window_label(F.timestamp_seconds(F.lit(22 * 3600)), 2)
    assert rows(spark.range(1).select(label)) == [("window_2200",)]


ITEM = "id_item_pedido string, id_pedido string, _ingest_timestamp timestamp"
ORDER = "id_pedido string, data_pedido date, _ingest_timestamp timestamp"


def test_items_wait_for_their_order_over_restarts(spark, store, tmp_path):
    from tillflow.streaming import late_items

    def deliver(name, schema, *cells):
        made = spark.createDataFrame([(*c[:-1], datetime(2026, 1, c[-1])) for c in cells], schema)
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return late_items.stream_of(spark, str(tmp_path / name), made)

    def states():
        matches = late_items.match_items(streams["items"], streams["orders"], "3 DAYS", "10 DAYS", "1 HOUR")
        late_items.store_matches(matches, store, "late", str(tmp_path / "cp"))
        every = spark.read.schema(ITEM).parquet(str(tmp_path / "items"))
        return {r.id_item_pedido: r.state for r in late_items.item_states(every, store).collect()}

    day = datetime(2026, 1, 1).date()
    streams = {"items": deliver("items", ITEM, ("1", "A", 2), ("2", "B", 2), ("3", "C", 2)), "orders": deliver("orders", ORDER, ("A", day, 1))}
    assert states() == {"1": "released", "2": "waiting", "3": "waiting"}
    deliver("orders", ORDER, ("B", day, 4))  # the stream was stopped and begins again
    assert states() == {"1": "released", "2": "released", "3": "waiting"}
    deliver("items", ITEM, ("4", "A", 9))
    deliver("orders", ORDER, ("Z", day, 9))
    assert states() == {"1": "released", "2": "released", "3": "expired", "4": "released"}
    assert store.read(late_items.RELEASED).count() == 3 and store.read(late_items.EXPIRED).count() == 1
    assert states()["4"] == "released" and store.read(late_items.RELEASED).count() == 3


def test_breaches_batch_by_batch_are_those_of_the_batch_operator(spark, tmp_path):
    import random

    from tillflow.operators import series
    from tillflow.streaming import breaches

    schema = "event_id long, ts timestamp, host string, name string, value double"
    draw, folder, cells = random.Random(4), str(tmp_path / "samples"), []
    minute = 0
    for i in range(400):
        minute += draw.choice([0, 0, 1, 1, 1, 2, 9])
        cells.append((i, datetime(2026, 1, 1) + timedelta(minutes=minute, seconds=draw.randrange(60)), draw.choice("ab"), "cpu", float(draw.choice([10, 50, 60, 70]))))
    cells += [(900, None, "a", "cpu", 99.0), (901, datetime(2026, 1, 1), "a", "cpu", None)]

    def watch():
        runs = breaches.watch(spark.readStream.schema(schema).parquet(folder), 40, tie="event_id", delay="30 minutes")
        breaches.write_runs(runs, str(tmp_path / "runs"), str(tmp_path / "cp"))
        return breaches.sustained(spark.read.parquet(str(tmp_path / "runs")), 2)

    for at in range(0, len(cells), 81):
        part = cells[at : at + 81]
        draw.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        found = watch()
        every = spark.read.schema(schema).parquet(folder).filter("value IS NOT NULL AND ts IS NOT NULL")
        expected = series.sustained_breaches(every, 40, 2, order=("ts", "event_id"))
        assert sorted(rows(found.select(*expected.columns))) == sorted(rows(expected))
    assert expected.count() > 5


def test_late_items_land_in_order_and_each_batch_is_computed_once(spark, store, tmp_path):
    from tillflow.streaming import late_items

    days = [datetime(2026, 1, 1) + timedelta(days=i) for i in range(100)]
    items = spark.createDataFrame([(str(i), f"O{i}", day) for i, day in enumerate(days)], ITEM)
    seen = [(f"O{i}", day.date(), day + timedelta(days=9 if i % 4 == 0 else 1)) for i, day in enumerate(days)]
    made, passes = {"items": items, "orders": spark.createDataFrame(seen, ORDER)}, spark.sparkContext.accumulator(0)
    for name, rows_of in made.items():
        late_items.set_apart(rows_of, str(tmp_path / "apart" / name), 40)
    counted = F.udf(lambda key: (passes.add(1), key)[1])
    landed = late_items.land_in_order(spark, {str(tmp_path / name): str(tmp_path / "apart" / name) for name in made})
    for _ in landed:
        streams = {name: late_items.stream_of(spark, str(tmp_path / name), made[name]) for name in made}
        matches = late_items.match_items(streams["items"], streams["orders"], "3 DAYS", "10 DAYS", "1 HOUR")
        late_items.store_matches(matches.withColumn("id_pedido", counted("id_pedido")), store, "late", str(tmp_path / "cp"))
    states = [r.state for r in late_items.item_states(items, store).collect()]
    assert (states.count("released"), states.count("expired"), states.count("waiting")) == (75, 24, 1)
    assert passes.value == 99


def test_taking_a_few_samples_of_a_series_needs_no_operations_on_frames(monkeypatch):
    """Streams have many series with a few samples each, for which a sorted frame costs milliseconds."""
    import pandas as pd

    from tillflow.streaming import breaches

    second = 1_000_000
    batch = pd.DataFrame({"_at": [90 * second, 61 * second, 90 * second, 5 * second], "_tie": [2, 9, 1, 0], "_beyond": [True, False, False, True]})
    for name in ("assign", "sort_values", "drop_duplicates", "itertuples"):
        monkeypatch.delattr(pd.DataFrame, name)
    minutes = {0: (4 * second, 7, False), 60 * second: (89 * second, 0, False)}
    breaches._take(minutes, batch)
    assert minutes == {0: (5 * second, 0, True), 60 * second: (90 * second, 2, True)}


def test_late_items_land_under_way_and_the_state_has_partitions_by_its_size(spark, store, tmp_path, monkeypatch):
    from tillflow.streaming import late_items

    days = [datetime(2026, 1, 1) + timedelta(days=i) for i in range(100)]
    items = spark.createDataFrame([(str(i), f"O{i}", day) for i, day in enumerate(days)], ITEM)
    seen = [(f"O{i}", day.date(), day + timedelta(days=9 if i % 4 == 0 else 1)) for i, day in enumerate(days)]
    made = {"items": items, "orders": spark.createDataFrame(seen, ORDER)}
    apart = {str(tmp_path / name): str(tmp_path / "apart" / name) for name in made}
    for name, rows_of in made.items():
        late_items.set_apart(rows_of, str(tmp_path / "apart" / name), 40)
    partitions = late_items.state_partitions(spark, apart)
    assert partitions == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(late_items, "STATE_BYTES", 16)
    assert late_items.state_partitions(spark, apart) > partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        landing = late_items.land_in_order(spark, apart)
        spans = [next(landing)]
        streams = {name: late_items.stream_of(spark, str(tmp_path / name), made[name]) for name in made}
        matches = late_items.match_items(streams["items"], streams["orders"], "3 DAYS", "10 DAYS", "1 HOUR")
        counted = (spans.append(span) or span for span in landing)
        late_items.store_matches(matches, store, "late", str(tmp_path / "cp"), counted, partitions)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    states = [r.state for r in late_items.item_states(items, store).collect()]
    assert (states.count("released"), states.count("expired"), states.count("waiting")) == (75, 24, 1)
    # one batch for each span, and one without files after the last
    assert store.state()[1]["batches"]["late"] == len(spans)
    assert len([p for p in (tmp_path / "cp" / "state" / "0").iterdir() if p.name.isdigit()]) == partitions
