"""The kept inventory of landing files: equal to a listing, at the cost of what changed."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from test_maintenance import landed, left

from tillflow.plans import pipeline
from tillflow.plans.workspace import Workspace
from tillflow.sources import inventory, tables
from tillflow.sources.inventory import Inventory


@pytest.fixture
def kept(store, tmp_path):
    (tmp_path / "raw").mkdir()
    return Inventory(store, str(tmp_path / "raw"))


def same(kept) -> bool:
    return sorted(rows(kept.files())) == sorted(rows(tables.list_files(kept.store.spark, kept.root)))


def test_only_changed_folders_are_listed(kept, tmp_path, monkeypatch):
    """500 files in 50 days: a new, a longer, an empty and a removed file cost the listing of their days alone."""
    root = tmp_path / "raw"
    landed(root, {f"2026/{1 + d // 25:02}/{1 + d % 25:02}/u{u}/pedido.csv": 5 for d in range(50) for u in range(10)})
    assert kept.refresh() == 50 and same(kept) and kept.files().count() == 500
    seen = []
    listing = inventory.inside
    monkeypatch.setattr(inventory, "inside", lambda files, folder: seen.append(folder.toString()[-10:]) or listing(files, folder))
    version = kept.store.state()[0]
    assert kept.refresh() == 0 and seen == [] and kept.store.state()[0] == version
    landed(root, {"2026/01/03/new/pedido.csv": 0, "2026/03/01/u1/pedido.csv": 0})
    (root / "2026/01/04/u7/pedido.csv").write_text("longer")
    (root / "2026/01/05/u8/empty.csv").write_text("")
    (root / "2026/02/06/u9/pedido.csv").unlink()
    assert kept.refresh() == 5 and same(kept)
    assert sorted(seen) == ["2026/01/03", "2026/01/04", "2026/01/05", "2026/02/06", "2026/03/01"]


def test_vanished_folders_loose_and_hidden_files(kept, tmp_path, monkeypatch):
    monkeypatch.setattr(inventory, "CHUNK", 2)
    root = tmp_path / "raw"
    assert kept.refresh() == 0 and kept.files().count() == 0
    landed(root, {"top.csv": 1, "2026/loose.csv": 1, "2026/01/01/a b/x=1%.csv": 1, "2026/01/02/[u]/a.csv": 1, "2026/01/02/b.csv": 1, "2026/01/02/_SUCCESS": 1})
    assert kept.refresh() == 3 and same(kept) and kept.files().count() == 5
    (root / "2026/01/01/a b/x=1%.csv").unlink()
    (root / "2026/01/01/a b").rmdir()
    (root / "2026/01/01").rmdir()
    (root / "top.csv").unlink()
    assert kept.refresh() == 1 and same(kept) and kept.files().count() == 3
    for name in ("2026/01/02/[u]/a.csv", "2026/01/02/b.csv", "2026/01/02/_SUCCESS", "2026/loose.csv"):
        (root / name).unlink()
    kept.refresh()
    assert same(kept) and kept.files().count() == 0


def test_what_the_mark_cannot_see_a_full_refresh_does(kept, tmp_path):
    root = tmp_path / "raw"
    landed(root, {"2026/01/01/u/a.csv": 9})
    kept.refresh()
    landed(root, {"2026/01/01/u/a.csv": 1})  # as many bytes, in the same place
    assert kept.refresh() == 0 and not same(kept)
    assert kept.refresh(full=True) == 1 and same(kept)


def test_retention_and_usage_take_the_inventory(spark, store, kept, tmp_path):
    root = tmp_path / "raw"
    landed(root, {f"2025/01/{d:02}/u/pedido.csv": 100 for d in range(1, 6)} | {"2026/01/01/u/pedido.csv": 1, "2026/01/01/v/pedido.csv": 100})
    ws = Workspace(spark, store.read, store)
    found = pipeline.run_file_retention(ws, str(root), datetime.now(), inventory=kept).first()
    assert (found.deleted_count, found.skipped_count) == (6, 1)
    assert left(root) == ["2026/01/01/u/pedido.csv"] and same(kept)
    assert pipeline.run_usage_report(ws, str(root), datetime.now(), inventory=kept).isEmpty()
