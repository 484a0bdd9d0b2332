"""A kept inventory of landing files: a table of them, brought up to date folder by folder.

The tree below ``root`` is cut into units, the folders ``depth`` levels down (year, month and day as a rule). Each unit has a
mark: how many files, bytes and folders it holds and when it changed, which the file system says in one call. Only units
with a mark that the table does not know are listed, CHUNK files at a time, and replaced in the table in one commit; units
that are gone are dropped. What passes through the driver at each refresh is therefore a mark for each unit and the files of the
changed units, not the files of all history. Files above the units are few; they are listed each time and form one unit.

A file whose content is replaced by as many bytes in a place below its unit's own folder leaves the mark as it is:
``refresh(full=True)`` lists everything. A mark is taken before its unit is listed, so what comes in between shows the next time.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame

from tillflow.session import stage
from tillflow.sources.tables import LISTED, TableStore, file_system, inside, listed, shown

CHUNK = 50_000
_SCHEMA = f"{LISTED}, unit string, mark string, unit_key string"


def _key(unit: str) -> str:
    return "u" + hashlib.sha256(unit.encode()).hexdigest()[:16]


class Inventory:
    def __init__(self, store: TableStore, root: str, depth: int = 3, name: str = "inventory.landing_files") -> None:
        self.store, self.root, self.depth, self.name = store, root.rstrip("/"), depth, name

    def files(self) -> DataFrame:
        """``path, uri, length, modificationTime`` of the files as of the last refresh."""
        if not self.store.exists(self.name):
            self.refresh()
        return self.store.read(self.name).drop("unit", "mark", "unit_key")

    def _units(self) -> tuple[dict[str, str], list[tuple]]:
        """The marks of the units, and the files above them."""
        files, target = file_system(self.store.spark, self.root)
        level, loose = [target] if files.exists(target) else [], []
        for _ in range(self.depth):
            held = [status for folder in level for status in files.listStatus(folder)]
            level = [status.getPath() for status in held if status.isDirectory()]
            loose += [listed(status) for status in held if not status.isDirectory()]
        marks = {}
        for unit in level:
            held = files.getContentSummary(unit)
            changed = files.getFileStatus(unit).getModificationTime()
            marks[unit.toString()] = f"{held.getFileCount()}:{held.getLength()}:{held.getDirectoryCount()}:{changed}"
        loose = sorted(shown(loose))
        if loose:
            marks[""] = hashlib.sha256(repr(loose).encode()).hexdigest()
        return marks, loose

    def _rows(self, unit: str, loose: list[tuple]) -> list[tuple]:
        if not unit:
            return loose
        files, target = file_system(self.store.spark, unit)
        return shown([listed(status) for status in inside(files, target)])

    def refresh(self, full: bool = False) -> int:
        """Bring the table up to date; returns how many units were listed."""
        spark, there = self.store.spark, self.store.exists(self.name)
        known = dict(self.store.read(self.name).select("unit", "mark").distinct().collect()) if there else {}
        marks, loose = self._units()
        changed = sorted(unit for unit, mark in marks.items() if full or known.get(unit) != mark)
        gone = known.keys() - marks.keys()
        if there and not changed and not gone:
            return 0
        frames, held = [], []
        for unit in changed:
            # A unit without a file to show has no row, so it is listed again the next time.
            for row in self._rows(unit, loose):
                held.append((*row, unit, marks[unit], _key(unit)))
                if len(held) >= CHUNK:
                    frames.append(stage(spark.createDataFrame(held, _SCHEMA)))
                    held = []
        rows = reduce(DataFrame.union, frames, spark.createDataFrame(held, _SCHEMA))
        old = sorted(_key(unit) for unit in gone | (known.keys() & set(changed)))
        with self.store.transaction() as changes:
            if there:
                changes.replace_partitions(self.name, rows, "unit_key", old)
            else:
                changes.append(self.name, rows, "unit_key")
        return len(changed)
