from __future__ import annotations

import os
from datetime import date, datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from tillflow.operators import bronze, maintenance, run_metrics
from tillflow.schemas import MONITORING, REFERENCE_SPECS
from tillflow.sources import reference
from tillflow.session import stage
from tillflow.sources.landing import file_inventory
from tillflow.sources.tables import create_tables

TODAY = date(2026, 2, 10)


def days(spark, *offsets: int):
    return spark.createDataFrame([(TODAY - timedelta(days=o),) for o in offsets], "order_date date")


def test_gaps_exclude_today_and_what_is_older(spark):
    have = [o for o in range(1, 31) if o not in (3, 30)]
    gaps = maintenance.detect_gaps(days(spark, *have, 0, 45), TODAY)
    assert [d for (d,) in rows(gaps)] == [TODAY - timedelta(days=30), TODAY - timedelta(days=3)]
    assert maintenance.detect_gaps(days(spark, *range(1, 31)), TODAY).isEmpty()


def test_backfill_looks_at_the_first_seven(spark):
    gaps = maintenance.detect_gaps(days(spark, *range(10, 31)), TODAY)  # days 9 … 1 ago are missing
    landed = days(spark, 9, 8, 2).withColumnRenamed("order_date", "data_pedido")
    left = maintenance.validate_backfill(gaps, landed)
    assert [(TODAY - d).days for (d,) in rows(left)] == [7, 6, 5, 4, 3]


def test_retention_counts_and_drops_partitions(spark, store):
    frame = spark.range(200).select("id", F.date_sub(F.lit(TODAY), F.col("id").cast("int")).alias("_ingest_date"))
    store.write("bronze.orders", frame, "_ingest_date")
    counts = maintenance.retention_rows({"bronze.orders": store.read("bronze.orders")}, TODAY)
    assert rows(counts) == [("bronze.orders", 109, 91)]
    dropped = store.drop_partitions_before("bronze.orders", "_ingest_date", maintenance.retention_cutoff(TODAY, 90))
    assert len(dropped) == 109
    left = store.read("bronze.orders")
    assert left.count() == 91 == maintenance.retained(frame, TODAY).count()
    assert rows(left.agg(F.min("_ingest_date"))) == [(TODAY - timedelta(days=90),)]


FILES = "path string, length long, modificationTime timestamp"


def test_file_retention(spark):
    files = spark.createDataFrame([("a", 1024, datetime(2025, 1, 1)), ("b", 2048, datetime(2026, 2, 1))], FILES)
    found = maintenance.retention_files(files, datetime(2026, 2, 10), 60)
    assert rows(found) == [(1, 1024, 1, True)]
    assert rows(maintenance.expired_files(files, datetime(2026, 2, 10), 60), "path") == [("a",)]


def test_dry_run_deletes_nothing_and_delete_does(spark, store, tmp_path):
    for name, age in (("old.csv", 100), ("new.csv", 1)):
        path = tmp_path / name
        path.write_text("x")
        stamp = datetime.now().timestamp() - age * 86400
        os.utime(path, (stamp, stamp))
    files = file_inventory(spark, str(tmp_path / "*.csv"))
    old = maintenance.expired_files(files, datetime.now())
    assert maintenance.retention_files(files, datetime.now()).first().deleted_count == 1
    assert sorted(os.listdir(tmp_path)) == ["new.csv", "old.csv"]
    assert store.delete_files(old) == 1
    assert sorted(os.listdir(tmp_path)) == ["new.csv"]


def landed(root, names: dict[str, int]):
    for name, age in names.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
        stamp = datetime.now().timestamp() - age * 86400
        os.utime(path, (stamp, stamp))


def left(root) -> list[str]:
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def test_expired_folders_go_as_a_whole(spark, store, tmp_path, monkeypatch):
    """Months of 300 old files cost a call a folder; a month that is mixed loses only what is old."""
    root = tmp_path / "raw"
    landed(root, {f"2020/{m:02}/{d:03}/pedido.csv": 100 for m in (1, 2) for d in range(300)})
    landed(root, {"2021/01/001/pedido.csv": 100, "2021/01/002/pedido.csv": 1, "top.csv": 100})
    files = file_inventory(spark, str(root))
    old = maintenance.expired_files(files, datetime.now())
    whole, delete, single = [], store._delete_folder, store.delete_files
    monkeypatch.setattr(store, "_delete_folder", lambda f, n, b: whole.append((f.rpartition("raw/")[2], n)) or delete(f, n, b))
    ones = []
    monkeypatch.setattr(store, "delete_files", lambda paths: ones.append(paths.count()) or single(paths))
    assert store.delete_expired(files, old, str(root)) == 602
    assert sorted(whole) == [("2020", 600), ("2021/01/001", 1)] and ones == [1]
    assert left(root) == ["2021/01/002/pedido.csv"]


def test_files_the_listing_does_not_know_stay(spark, store, tmp_path):
    """A file that came since the listing, or a hidden one, keeps its folder; what is old goes all the same."""
    root = tmp_path / "raw"
    landed(root, {"2020/01/a.csv": 100, "2020/01/b.csv": 100, "2020/02/a.csv": 100, "2020/02/_SUCCESS": 100, "2019/a.csv": 100})
    files = stage(file_inventory(spark, str(root)))
    landed(root, {"2020/01/new.csv": 0})
    assert store.delete_expired(files, maintenance.expired_files(files, datetime.now()), str(root)) == 4
    assert left(root) == ["2020/01/new.csv", "2020/02/_SUCCESS"]


def test_deleting_from_empty_or_fresh_folders_does_nothing(spark, store, tmp_path):
    (tmp_path / "raw").mkdir()
    for names in ({}, {"2020/01/a.csv": 1}):
        landed(tmp_path / "raw", names)
        files = file_inventory(spark, str(tmp_path / "raw"))
        assert store.delete_expired(files, maintenance.expired_files(files, datetime.now()), str(tmp_path / "raw")) == 0
    assert left(tmp_path / "raw") == ["2020/01/a.csv"]


def test_storage_and_alerts(spark):
    files = spark.createDataFrame([("objects", 3 * 2**30), ("objects", 2**30), ("warehouse", 2**29)], "store string, length long")
    usage = maintenance.storage_usage(files)
    assert sorted(rows(usage)) == [("objects", 4 * 2**30, 4.0, 5.0, 80.0), ("warehouse", 2**29, 0.5, 10.0, 5.0)]
    assert maintenance.usage_alert(usage).isEmpty()  # 80 is not above 80
    assert rows(maintenance.usage_alert(usage, 79.9), "store") == [("objects",)]
    assert rows(maintenance.storage_alert(files, 4.4)) == [(4.5, True)]
    snapshot = maintenance.usage_snapshot(usage, datetime(2026, 2, 10, 4))
    assert snapshot.schema.names == MONITORING["free_tier_usage"].names
    assert [f.dataType for f in snapshot.schema] == [f.dataType for f in MONITORING["free_tier_usage"]]
    assert rows(snapshot, "gcs_usage_pct", "bq_storage_gb", F.length("snapshot_id")) == [(80.0, 0.5, 12)]


def test_data_age(spark):
    frame = days(spark, 5, 2)
    assert rows(maintenance.data_age_hours(frame, datetime(2026, 2, 10, 0, 59)), "hours_since_last_data", "alert") == [(48, False)]
    assert rows(maintenance.data_age_hours(frame, datetime(2026, 2, 10, 1, 0)), "hours_since_last_data", "alert") == [(49, True)]


def test_query_volume_and_cost(spark):
    jobs = spark.createDataFrame(
        [
            (datetime(2026, 2, 9), "DONE", 500 * 2**30),
            (datetime(2026, 2, 8), "DONE", 301 * 2**30),
            (datetime(2026, 2, 8, 5), "RUNNING", 2**40),
            (datetime(2025, 12, 1), "DONE", 2**40),
        ],
        "creation_time timestamp, state string, bytes long",
    )
    now = datetime(2026, 2, 10)
    assert rows(maintenance.query_volume(jobs, now)) == [(801.0, True)]
    cost = maintenance.daily_query_cost(jobs, now)
    assert rows(cost, F.dayofmonth("query_date"), "estimated_cost") == [(9, 2.68), (8, 7.11)]


def test_counts_and_comparison(spark):
    found = maintenance.layer_comparison({"orders": spark.range(5)}, {"orders": spark.range(3)})
    assert rows(found) == [("orders", 5, 3, -2)]


def test_run_metrics_fit_their_table(spark):
    counts = maintenance.table_counts({"a": spark.range(5), "b": spark.range(7)})
    frame = run_metrics.run_summary(counts, "daily", TODAY, 12.5, "run")
    assert frame.schema.names == MONITORING["pipeline_metrics"].names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in MONITORING["pipeline_metrics"]]
    assert rows(frame, "metric_name", "metric_value", "metric_unit") == [
        ("pipeline_status", 1.0, "boolean"),
        ("duration", 12.5, "seconds"),
        ("rows_processed", 12.0, "rows"),
    ]
    failed = spark.createDataFrame([("b",), ("a",)], "check_name string")
    event = run_metrics.quality_failure(failed, "quality", TODAY)
    assert rows(event, "metric_value", "details") == [(2.0, '{"failed_checks":["a","b"]}')]
    failure = run_metrics.task_failure(spark, "daily", "build", "e" * 900, TODAY)
    assert rows(failure, F.length("details")) == [(len('{"error":""}') + 500,)]
    missed = run_metrics.sla_miss(spark, "daily", ["t1"], [], TODAY)
    assert rows(missed, "details") == [('{"tasks":["t1"],"blocking_tasks":[]}',)]


# --- reference tables ---


def source_tables(spark, empty=()):
    data = {
        "pais": [(1, "Brasil")],
        "estado": [(2, 1, "SC"), (1, 1, "RS")],
        "unidade": [(2, "U2", 1), (1, "U1", 2)],
        "produto": [(10, "Bowl"), (9, "Wrap")],
    }

    def read(spec):
        columns = list(spec.renames.values())
        schema = ", ".join(f"{c} {'string' if c.startswith('nome') else 'long'}" for c in columns)
        return spark.createDataFrame([] if spec.source_table in empty else data[spec.source_table], schema)

    return read


def lines(folder: str, name: str) -> list[str]:
    parts = sorted(p for p in os.listdir(f"{folder}/{name}") if p.startswith("part-"))
    return [line for part in parts for line in open(f"{folder}/{name}/{part}", encoding="utf-8").read().splitlines()]


def test_extract_writes_ordered_files_and_load_replaces(spark, store, tmp_path):
    target = str(tmp_path / "reference_data")
    status = reference.extract_reference(spark, source_tables(spark), target)
    assert rows(reference.extract_summary(status)) == [(["estado", "pais", "produto", "unidade"], [], 7)]
    assert lines(target, "produto.csv")[0] == "Id_Produto;Nome_Produto"
    assert [x for x in lines(target, "unidade.csv") if not x.startswith("Id_")] == ["1;U1;2", "2;U2;1"]
    for _ in range(2):
        loaded = reference.load_reference(spark, target, store, datetime(2026, 1, 1))
        assert dict((t, n) for t, s, n in rows(loaded)) == {"countries": 1, "states": 2, "units": 2, "products": 2}
    assert rows(store.read("bronze.states").orderBy("id_estado"), "id_estado", "id_pais", "nome_estado") == [(1, 1, "RS"), (2, 1, "SC")]
    assert store.read("bronze.states").filter("_ingest_timestamp is null").isEmpty()


def test_empty_source_keeps_the_previous_file(spark, tmp_path):
    target = str(tmp_path / "reference_data")
    reference.extract_reference(spark, source_tables(spark), target)
    before = lines(target, "produto.csv")
    status = reference.extract_reference(spark, source_tables(spark, empty=("produto",)), target)
    assert ("produto", "skipped", 0) in rows(status)
    assert lines(target, "produto.csv") == before
    assert rows(reference.extract_summary(status), "tables_skipped", "total_rows") == [(["produto"], 5)]


def test_a_bad_reference_file_does_not_stop_the_others(spark, store, tmp_path):
    target = str(tmp_path / "reference_data")
    reference.extract_reference(spark, source_tables(spark), target)
    status = reference.load_reference(spark, str(tmp_path / "nowhere"), store)
    assert all(s.startswith("error") for _, s, _ in rows(status))
    assert reference.load_reference(spark, target, store).filter("status = 'loaded'").count() == 4


def test_relational_tables_are_read_in_key_ranges(spark):
    """No database here: the reader is given a stand-in for ``spark.read`` that records what it is asked for."""
    from types import SimpleNamespace

    asked = []

    def jdbc(url, table, *ranges, properties):
        asked.append((table, *ranges))
        if table.startswith("("):
            return spark.createDataFrame([(3, 90)], "low long, high long")
        return spark.createDataFrame([(3, "x", True)], "id_produto long, nome_produto string, other boolean")

    read = reference.jdbc_reader(SimpleNamespace(read=SimpleNamespace(jdbc=jdbc)), "jdbc:x", {}, partitions=4)
    found = read(next(s for s in REFERENCE_SPECS if s.table == "products"))
    assert found.columns == ["id_produto", "nome_produto"]
    assert asked == [
        ("(SELECT min(id_produto) AS low, max(id_produto) AS high FROM produto) ends",),
        ("produto", "id_produto", 3, 91, 4),
    ]


def test_retry_waits_and_gives_up():
    waited, calls = [], []

    def action():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("down")
        return "up"

    assert reference.with_retry(action, sleep=waited.append) == "up"
    assert waited == [30, 60]

    def never():
        raise OSError("down")

    try:
        reference.with_retry(never, sleep=waited.append)
        raise AssertionError("should have raised")
    except OSError:
        pass


def test_insert_if_absent(spark):
    there = spark.createDataFrame([(1, "old")], "id long, name string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (3, None)], "id long, name string")
    assert sorted(rows(bronze.insert_if_absent(there, new, "id"))) == [(2, "a"), (3, None)]


def test_tables_are_created_once(spark, tmp_path):
    made = create_tables(spark, str(tmp_path / "lake"), "t_")
    assert len(made) == 9
    assert create_tables(spark, str(tmp_path / "lake"), "t_") == made
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE t_bronze.orders").collect()}
    assert described["vlr_pedido"] == "decimal(10,2)"
    assert "# Partition Information" in described
    assert [s.table for s in REFERENCE_SPECS] == ["countries", "states", "units", "products"]
