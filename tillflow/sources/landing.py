"""Landing files: semicolon-separated text, one header line, found by base name under a folder tree.

Files are read in two passes. The first takes the header of each file and from it the file's layout: how many columns it has
and which of them are wanted. Files of one layout are then one native CSV scan with a schema of its own, so
neither the number nor the names of the columns are fixed, and the work is linear in the size of a file. Spark's reader puts a
record of another width aside in the corrupt-record column; only those records are looked at cell by cell. What the scans
give is staged once, and rows, reports and rejected files are all read from there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.functions.text import present
from tillflow.operators.bronze import to_bronze
from tillflow.operators.validation import file_report, missing_columns, quarantine_report, rejected_files, valid_rows
from tillflow.schemas import FILE_SPECS, FileSpec
from tillflow.session import stage, together
from tillflow.sources.tables import TableStore, list_files, plain_path

MAX_FILE_BYTES = 10 * 1024 * 1024
ROOT = "raw/csv_sales/"
PROCESSING_FAILED = "Processing failed. See the job log for details."
#: Columns up to which a scan has the whole width of a layout; of wider ones only those up to the last wanted one.
WIDE = 5000

# A quote means something at the beginning of a cell only. Repetition is possessive, so a scan is linear.
_CELL = r'(?:"(?:[^"]|"")*+")?[^;\r\n]*+'
_RECORD = f"{_CELL}(?:;{_CELL})*+"
_QUOTED = r'(?s)^"((?:[^"]|"")*+)"(.*)$'
# The last quote of the text opens a cell, and what follows is not the end of one.
_ENDLESS = r'(?s)(?:^|[;\r\n])"(?![ \t]*(?:[;\r\n]|$))[^"]*+$'
_BLANK_LINES = r"^\uFEFF?((?:[ \t]*+(?:\r\n|\n|\r))*+)"


def relative_path(path: Column, root: str) -> Column:
    """The part of a file path from ``root`` on, e.g. raw/csv_sales/…; the whole path when root is not in it."""
    at = F.instr(path, root)
    return F.when(at > 0, F.substr(path, at)).otherwise(path)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of every file below ``path``, those of zero bytes included.

    File contents are not read. Paths and sizes pass through the driver, as in any listing: give the folder of a day or
    a shop, not of all history.
    """
    return list_files(spark, path)


def route(path: Column, prefix: str) -> Column:
    """The table a file belongs to, by prefix, extension and base name; null for files to ignore."""
    base = F.element_at(F.split(path, "/"), -1)
    table = F.coalesce(*[F.when(base == spec.base_name, F.lit(spec.table)) for spec in FILE_SPECS])
    return F.when(path.contains(prefix) & path.endswith(".csv"), table)


def oversized(files: DataFrame, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Files above the size limit, with the error they are rejected for."""
    limit = f"File exceeds {max_bytes // (1024 * 1024)}MB limit (%s bytes)"
    text = F.format_string(limit, F.format_number("length", 0))
    return files.filter(F.col("length") > max_bytes).select("source_file", text.alias("error"))


def whole_files(reader, path: str, spec: FileSpec, root: str) -> DataFrame:
    """Files of one kind as one text each; the same for batch and stream readers."""
    texts = reader.format("text").options(wholetext="true", recursiveFileLookup="true", pathGlobFilter=spec.base_name)
    named = texts.load(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    return named.filter(route(F.col("file"), root) == spec.table)


def read_texts(spark: SparkSession, path: str, spec: FileSpec, root: str = ROOT, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """The texts of the files of one kind. The size limit prunes the file listing."""
    return whole_files(spark.read, path, spec, root).filter(F.col("size") <= max_bytes)


@dataclass(frozen=True)
class Landing:
    """One kind of landing file after parsing and validation."""

    valid: DataFrame
    report: DataFrame
    rejected: DataFrame


def cells(record: Column) -> Column:
    """The cells of a record. In a quoted cell a doubled quote stands for one, and separators are text."""
    found = F.regexp_extract_all(F.concat(F.lit(";"), record), F.lit(f";({_CELL})"), F.lit(1))

    def plain(cell: Column) -> Column:
        inner = F.replace(F.regexp_extract(cell, _QUOTED, 1), F.lit('""'), F.lit('"'))
        return F.when(F.rlike(cell, F.lit(_QUOTED)), F.concat(inner, F.regexp_extract(cell, _QUOTED, 2))).otherwise(cell)

    return F.transform(found, plain)


def layouts(texts: DataFrame, spec: FileSpec) -> DataFrame:
    """``file, most, endless, layout``: the layout of each file by its header, the first line that is not blank.

    ``layout`` has the number of columns, the place of each wanted column (null where the header lacks it), the line end, and
    whether lines of blanks come before the header. ``most`` bounds the cells of a line. ``endless`` files open a
    quoted cell that never ends.
    """
    parts = [F.regexp_extract("value", f"{_BLANK_LINES}({_RECORD})(\r?)(\n?)", i) for i in (1, 2, 3, 4)]
    lines = F.transform(F.split("value", "[\r\n]+"), lambda line: F.octet_length(line) - F.octet_length(F.replace(line, F.lit(";"), F.lit(""))))
    # An array of one is exploded so that its fields are computed once a file, not once for each use of them.
    first = F.struct(F.transform(cells(parts[1]), lambda name: F.trim(name)).alias("header"), parts[0].alias("before"), F.concat(*parts[2:]).alias("line_end"))
    found = texts.select("file", (F.array_max(lines) + 1).alias("most"), F.rlike("value", F.lit(_ENDLESS)).alias("endless"), F.inline(F.array(first)))
    places = [F.nullif(F.array_position("header", F.lit(name)), F.lit(0)).cast("int") for name in spec.columns]
    layout = F.struct(
        F.array_size("header").alias("width"),
        F.array(*places).alias("places"),
        F.when(F.col("line_end") == "\r", "\r").otherwise("\n").alias("line_end"),
        (F.length(F.replace("before", F.lit("\n"), F.lit(""))) > 0).alias("blanks"),
        (F.array_size(missing_columns(F.col("header"), spec)) == 0).alias("complete"),
    )
    return found.select("file", "most", "endless", layout.alias("layout"))


def _scan_layout(spark: SparkSession, files: list[str], layout, most: int, spec: FileSpec) -> DataFrame:
    """The records of the files of one layout: wanted cells, ``_source_file, _row, _broken``.

    A record is broken if it is wider than the header. Blank lines are left out; a shorter record has nulls. Files whose
    header lacks a column are scanned for broken records only.
    """
    wanted = [place for place in layout.places if place] if layout.complete else [1]
    shown = layout.width if layout.complete and layout.width <= WIDE else max(wanted)
    names = [f"c{i}" for i in range(1, shown + 1)]
    reader = spark.read.schema(", ".join(f"{name} string" for name in [*names, "_raw"])).options(
        sep=";", quote='"', escape='"', multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_raw",
        lineSep=layout.line_end, header=not layout.blanks, maxColumns=max(20480, most + shown + 2),
    )
    found = reader.csv([plain_path(file) for file in files])
    if layout.blanks:  # the reader would take a line of blanks for the header
        same = [F.trim(F.col(f"c{p}")) == F.lit(name) for name, p in zip(spec.columns, layout.places, strict=True) if p and p <= shown]
        found = found.filter(~F.coalesce(reduce(Column.__and__, same, F.lit(False)), F.lit(False)))
    blank = F.col("_raw").isNotNull() & (F.trim(F.translate("_raw", "\r\t", "  ")) == "")
    wide = F.regexp_count(F.concat(F.lit(";"), "_raw"), F.lit(f";{_CELL}")) > layout.width
    # Spark does not read the corrupt records alone, so files without rows give their first cell.
    read = layout.places if layout.complete else [1] + [None] * (len(spec.columns) - 1)
    picked = [_cell(F.col(f"c{p}")) if p else F.lit(None).cast("string") for p in read]
    place = F.monotonically_increasing_id()  # a file is one split, so this grows with the position in it
    return found.filter(~blank).select(
        *[cell.alias(name) for name, cell in zip(spec.columns, picked, strict=True)],
        F.col("_metadata.file_path").alias("_source_file"),
        place.alias("_row"),
        F.coalesce(wide, F.lit(False)).alias("_broken"),
        F.lit(layout.complete).alias("_complete"),
    )


def _cell(cell: Column) -> Column:
    """A cell without the return of a line end, and without the quotes of a quoted beginning, which the reader leaves there."""
    cell = F.rtrim(cell, F.lit("\r"))
    tail = r'(?s)^"((?:[^"]|"")*+)"([^"].*)$'
    inner = F.concat(F.replace(F.regexp_extract(cell, tail, 1), F.lit('""'), F.lit('"')), F.regexp_extract(cell, tail, 2))
    return present(F.when(F.startswith(cell, F.lit('"')) & F.rlike(cell, F.lit(tail)), inner).otherwise(cell))


def split_files(texts: DataFrame, spec: FileSpec) -> tuple[DataFrame, DataFrame]:
    """Text rows by column name, and the files that cannot be read at all; ``_source_file`` is the full path.

    ``texts`` (``file, value``) are read for their headers only. File names pass through the driver, as in any listing, with
    a list of names for each layout. Files that lack a column give no rows.
    """
    spark = texts.sparkSession
    found = stage(layouts(texts, spec))
    endless = found.filter("endless").select(F.col("file").alias("source_file"))
    grouped = found.filter("NOT endless").groupBy("layout").agg(F.max("most").alias("most"), F.collect_list("file").alias("files")).collect()
    scans = together(spark, *[partial(_scan_layout, spark, row.files, row.layout, row.most, spec) for row in grouped])
    columns = ", ".join(f"{name} string" for name in [*spec.columns, "_source_file"])
    none = spark.createDataFrame([], f"{columns}, _row bigint, _broken boolean, _complete boolean")
    parsed = stage(reduce(DataFrame.unionByName, scans, none))
    broken = parsed.filter("_broken").select(F.col("_source_file").alias("source_file")).distinct()
    rows = parsed.filter("_complete").drop("_broken", "_complete")
    if not broken.isEmpty():
        rows = rows.join(broken, rows["_source_file"] == broken["source_file"], "left_anti")
    return rows, broken.unionByName(endless).withColumn("error", F.lit(PROCESSING_FAILED))


def process(texts: DataFrame, files: DataFrame, spec: FileSpec, root: str = ROOT, max_bytes: int = MAX_FILE_BYTES) -> Landing:
    """Parse and validate the files of one kind.

    ``files`` lists the files that were due (``source_file``, ``length``), so that a file without any line is rejected too.
    Files are told apart by their full paths; the results name them from ``root`` on. The same function serves batch
    loads and streaming micro-batches.
    """
    return judge(*split_files(texts, spec), files, spec, root, max_bytes)


def judge(rows: DataFrame, broken: DataFrame, files: DataFrame, spec: FileSpec, root: str = ROOT, max_bytes: int = MAX_FILE_BYTES) -> Landing:
    """Validate what :func:`split_files` gave for the ``files`` that were due."""
    report = file_report(rows, spec)
    too_big = oversized(files, max_bytes)
    unreadable = broken.unionByName(too_big)
    empty = rejected_files(files.join(unreadable, "source_file", "left_anti"), report)

    def named(frame: DataFrame, column: str) -> DataFrame:
        return frame.withColumn(column, relative_path(F.col(column), root))

    rejected = unreadable.unionByName(empty).withColumn("path", F.col("source_file"))
    return Landing(named(valid_rows(rows, spec), "_source_file"), named(report, "source_file"), named(rejected, "source_file"))


def due_files(spark: SparkSession, path: str, spec: FileSpec, root: str = ROOT) -> DataFrame:
    """The files of one kind below ``path`` with their sizes; ``source_file`` is the full path."""
    files = file_inventory(spark, path).filter(route(F.col("path"), root) == spec.table)
    return files.select(F.col("uri").alias("source_file"), "length", "modificationTime")


def scan(
    spark: SparkSession, path: str, spec: FileSpec, root: str = ROOT, max_bytes: int = MAX_FILE_BYTES
) -> Landing:
    """Read, route and validate all files of one kind below ``path``."""
    return process(read_texts(spark, path, spec, root, max_bytes), due_files(spark, path, spec, root), spec, root, max_bytes)


def lines_of(spark: SparkSession, files: list[str]) -> DataFrame:
    """The lines of files as they came in: ``file, line_position, line``, positions from 0. Large files are read in splits.

    The lines of a split are numbered on their own and offset by the lines of the splits before it.
    """
    if not files:
        return spark.createDataFrame([], "file string, line_position bigint, line string")
    numbered = spark.read.text([plain_path(file) for file in files]).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    numbered = stage(numbered)
    splits = numbered.groupBy("file", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1))
    offsets = splits.select("file", "_split", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_offset"))
    return numbered.join(offsets, ["file", "_split"]).select("file", (F.col("_id") + F.col("_offset")).alias("line_position"), "line")


def quarantine_lines(rejected: DataFrame, root: str = ROOT) -> DataFrame:
    """The lines of rejected files, to be kept as they came in: file, line position, text. File names pass through the driver."""
    files = [row["path"] for row in rejected.select("path").distinct().collect()]
    kept = lines_of(rejected.sparkSession, files)
    return kept.select(relative_path(F.col("file"), root).alias("source_file"), "line_position", "line")


def store_landing(landing: Landing, spec: FileSpec, store: TableStore, root: str = ROOT, as_of=None, batch: tuple[str, int] | None = None) -> None:
    """Valid rows to bronze, lines and error reports of rejected files to quarantine: all of it or nothing.

    Neither side needs the other, so they are written at the same time, and become visible together.
    """
    with store.transaction(batch) as changes:

        def take_valid() -> None:
            changes.append(f"bronze.{spec.table}", to_bronze(landing.valid, spec, as_of), "_ingest_date")

        def take_rejected() -> None:
            rejected = stage(landing.rejected)
            now = F.current_timestamp() if as_of is None else as_of
            reports = quarantine_report(rejected, now).select("source_file", "error", "report_path", "report", F.current_date().alias("_report_date"))
            changes.append("quarantine.reports", reports, "_report_date", kind="json")
            changes.append("quarantine.lines", quarantine_lines(rejected, root))

        together(store.spark, take_valid, take_rejected)


def load(
    spark: SparkSession,
    path: str,
    spec: FileSpec,
    store: TableStore,
    root: str = ROOT,
    as_of=None,
    max_bytes: int = MAX_FILE_BYTES,
    batch: tuple[str, int] | None = None,
) -> bool:
    """Take in all files of one kind below ``path``: what the stream does file by file, in one batch.

    A failure leaves all tables as they were. With a ``batch`` (name and number) the load is done once: repeated, it does
    nothing. Returns whether rows were loaded by this call.
    """
    if batch and store.committed(batch):
        return False
    texts = read_texts(spark, path, spec, root, max_bytes)
    landing = process(texts, due_files(spark, path, spec, root), spec, root, max_bytes)
    store_landing(landing, spec, store, root, as_of, batch)
    return True
