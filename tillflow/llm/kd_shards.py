"""Shards of nearly equal bytes by a k-d tree over document metadata.

All documents are one cell. A cell of several shards is split at the weighted median along its widest dimension, measured
against that dimension's range over all documents, until every cell is one shard; a cell of an odd number of shards is
split in proportion. The medians of a level are found for all its cells at once, by histograms over ranges of
the key that are narrowed until one key is left; a round is one aggregation. Documents that tie on the dimension,
as those of a hot source do, are split by a hash of the row in the same way, so no value is too frequent to be divided.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import materialise

DIGIT = 12  # bits of a key that one histogram resolves
KEY_BITS, TIE_BITS = 48, 36
SLOT_ROWS = 5_000


def value_ranks(docs: DataFrame, name: str) -> DataFrame:
    """``value, rank``: the distinct values of a text column, numbered from 1 in the order of their bytes.

    The values are sorted over all tasks; a task numbers its own, and the numbers of the tasks before it are added.
    """
    distinct = docs.select(F.col(name).cast("string").alias("value")).where("value IS NOT NULL").distinct()
    ordered = materialise(distinct.orderBy("value").withColumn("_id", F.monotonically_increasing_id()))
    task = F.shiftright("_id", 33)
    counted = ordered.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1))  # a row for each task
    offsets = counted.select("_task", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_id") - F.shiftleft("_task", 33) + 1
    return ordered.join(F.broadcast(offsets), task == F.col("_task")).select("value", rank.alias("rank"))


def dimensions() -> dict[str, Column | str]:
    """Metadata of documents that cells are split along: whole numbers of at most KEY_BITS bits, or the name of a text column.

    A text column counts by the rank of its value, 0 for null.
    """
    return {
        "language": "lang",
        "source": "source",
        "length": (F.log2(F.coalesce(F.octet_length("text"), F.lit(0)) + 1.0) * float(1 << 42)).cast("bigint"),
    }


def _with_axes(docs: DataFrame, axes: dict[str, Column | str]) -> DataFrame:
    """``doc_id, text`` and the axes as numbers."""
    names = [f"_axis{i}" for i in range(len(axes))]
    found = docs.select("doc_id", "text", *[axis.alias(name) if isinstance(axis, Column) else F.col(axis).cast("string").alias(name) for name, axis in zip(names, axes.values(), strict=True)])
    for name, axis in zip(names, axes.values(), strict=True):
        if not isinstance(axis, Column):
            ranks = materialise(value_ranks(docs, axis)).withColumnsRenamed({"value": "_value", "rank": "_rank"})
            found = found.join(ranks, F.col(name) == F.col("_value"), "left")
            found = found.withColumn(name, F.coalesce("_rank", F.lit(0))).drop("_value", "_rank")
    return found


def _cut(rows: DataFrame, key: Column, bits: int) -> DataFrame:
    """For each cell the key at which the running bytes of its rows, in the order of the key, pass ``goal``.

    ``rows`` have ``cell, size, goal``; gives ``cell, cut, left``, where ``left`` counts the bytes of smaller keys.
    """
    zero = F.lit(0).cast("bigint")
    cuts = materialise(rows.select("cell", "goal").distinct().select("cell", "goal", zero.alias("cut"), zero.alias("left")))
    for shift in range(bits - DIGIT, -1, -DIGIT):
        inside = rows.drop("goal").join(cuts, "cell").where(F.shiftright(key, shift + DIGIT) == F.col("cut"))
        digit = F.shiftright(key, shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        counted = inside.groupBy("cell", "goal", "cut", "left", digit.alias("_digit")).agg(F.sum("size").alias("_bytes"))
        # At most 2 ** DIGIT rows of a cell.
        running = F.sum("_bytes").over(W.partitionBy("cell").orderBy("_digit")) - F.col("_bytes") + F.col("left")
        reached = counted.withColumn("_before", running).where("_before <= goal")
        reached = reached.groupBy("cell", "goal").agg(F.max(F.struct("_digit", "_before", "cut")).alias("_m"))
        cut = F.shiftleft("_m.cut", DIGIT) + F.col("_m._digit")
        cuts = materialise(reached.select("cell", "goal", cut.alias("cut"), F.col("_m._before").alias("left")))
    return cuts.select("cell", "cut", "left")


def _widest(rows: DataFrame, names: list[str], ranges: dict[str, float]) -> DataFrame:
    """For each cell the number of its widest dimension, its bytes and the bytes that belong left of the cut."""
    least = [F.min(n).alias(f"_a{n}") for n in names]
    most = [F.max(n).alias(f"_z{n}") for n in names]
    found = rows.groupBy("cell", "shards").agg(F.sum("size").alias("_all"), *least, *most)
    widths = [F.struct(((F.col(f"_z{n}") - F.col(f"_a{n}")) / ranges[n]).alias("w"), F.lit(-i).alias("i")) for i, n in enumerate(names)]
    goal = (F.col("_all") * F.floor(F.col("shards") / 2) / F.col("shards")).cast("bigint")
    return found.select("cell", (-F.greatest(*widths)["i"] if len(widths) > 1 else F.lit(0)).alias("_dim"), goal.alias("goal"))


def _split(rows: DataFrame, names: list[str], ranges: dict[str, float]) -> DataFrame:
    """One level of the tree: every cell of several shards becomes two."""
    several = rows.where("shards > 1")
    chosen = materialise(_widest(several, names, ranges))
    key = F.lit(0).cast("bigint")
    for i, name in enumerate(names):
        key = F.when(F.col("_dim") == i, F.col(name)).otherwise(key)
    keyed = several.join(chosen, "cell").withColumn("_key", key)
    cuts = _cut(keyed.select("cell", "goal", "size", "_key"), F.col("_key"), KEY_BITS)
    ties = keyed.join(cuts, "cell").where("_key = cut").select("cell", "size", "tie", (F.col("goal") - F.col("left")).alias("goal"))
    tie_cuts = _cut(ties, F.col("tie"), TIE_BITS).select("cell", F.col("cut").alias("_tie_cut"), F.col("left").alias("_tie_left"))
    cells = materialise(chosen.join(cuts, "cell").join(tie_cuts, "cell"))
    # The row at the cut goes where it leaves the two sides closer to their goals.
    at_cut = (F.col("left") + F.col("_tie_left")) * 2 + F.col("size") <= F.col("goal") * 2
    tied_left = (F.col("tie") < F.col("_tie_cut")) | ((F.col("tie") == F.col("_tie_cut")) & at_cut)
    first = (F.col("_key") < F.col("cut")) | ((F.col("_key") == F.col("cut")) & tied_left)
    half = F.floor(F.col("shards") / 2).cast("int")
    joined = rows.join(cells, "cell", "left").withColumn("_key", key).withColumn("_first", first)
    ready = F.col("shards") == 1
    cell = F.when(ready | F.col("_first"), F.col("cell")).otherwise(F.col("cell") + half)
    shards = F.when(ready, 1).when(F.col("_first"), half).otherwise(F.col("shards") - half)
    kept = [c for c in rows.columns if c not in ("cell", "shards")]
    return materialise(joined.select(*kept, cell.cast("int").alias("cell"), shards.cast("int").alias("shards")))


def plan_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, axes: dict[str, Column | str] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, mark`` for every row of ``docs`` (``doc_id, text`` and what ``axes`` read).

    Either the number of ``shards`` is given, or ``target_bytes``, of which it follows. ``size`` is the UTF-8 length of the
    text plus one, so a null or empty text (checksum 0) weighs one byte. ``slot`` numbers the rows of a shard without gaps.
    Repeated rows are documents of their own; a null in an axis is its smallest value. An empty table gives an empty
    result, and with fewer documents than shards some shards stay empty. Reruns agree.
    """
    axes = axes or dimensions()
    names = [f"_axis{i}" for i in range(len(axes))]
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = _with_axes(docs, axes).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("mark"),
        *[F.col(name).cast("bigint").alias(name) for name in names],
    )
    # Equal rows are told apart by a number, else no hash could divide them.
    counted = slim.groupBy(*slim.columns).agg(F.count(F.lit(1)).alias("_n"))
    copies = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).drop("_n")
    tie = F.shiftrightunsigned(F.xxhash64("mark", "_copy"), 64 - TIE_BITS)
    rows = materialise(copies.withColumn("tie", tie))
    said = rows.agg(F.sum("size").alias("all"), *[(F.max(n) - F.min(n)).alias(n) for n in names]).first()
    shards = shards or max(1, -(-(said["all"] or 0) // target_bytes))
    ranges = {n: float(said[n] or 1) for n in names}
    rows = rows.select("*", F.lit(0).alias("cell"), F.lit(shards).alias("shards"))
    for _ in range((shards - 1).bit_length()):
        rows = _split(rows, names, ranges)
    return _slots(rows.withColumnRenamed("cell", "shard")).select("doc_id", "size", "text_crc32", "shard", "slot", "mark")


def _slots(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard: ranges of the tie hash are counted, then numbered on their own."""
    sizes = rows.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(SLOT_ROWS))).alias("_ranges"))
    part = F.shiftright(F.col("tie") * F.least("_ranges", F.lit(1 << 20)), TIE_BITS)
    ranged = materialise(rows.join(materialise(sizes), "shard").withColumn("_range", part))
    counted = ranged.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    offsets = materialise(counted.select("shard", "_range", F.coalesce(before, F.lit(0)).alias("_offset")))
    place = F.row_number().over(W.partitionBy("shard", "_range").orderBy("tie", "doc_id", "mark", "_copy"))
    numbered = ranged.withColumn("_place", place).join(offsets, ["shard", "_range"])
    return numbered.withColumn("slot", (F.col("_offset") + F.col("_place") - 1).cast("bigint"))


def shard(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, ready to be written partitioned by shard; columns so named are replaced.

    Rows that agree in doc_id and text take the places planned for them in the order of their other columns.
    """
    docs = docs.drop("shard", "slot")
    names = docs.columns
    planned = plan_shards(docs, **options)
    number = F.row_number().over(W.partitionBy("mark", "doc_id").orderBy("shard", "slot"))
    planned = planned.select("shard", "slot", F.col("mark").alias("_m"), F.col("doc_id").alias("_id"), number.alias("_number"))
    own = F.row_number().over(W.partitionBy("_mark", "doc_id").orderBy(F.xxhash64(*names)))
    marked = docs.withColumn("_mark", F.xxhash64("doc_id", "text")).withColumn("_own", own)
    same = (F.col("_mark") == F.col("_m")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_number"))
    return marked.join(materialise(planned), same).select(*names, "shard", "slot")
