"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source's target divided by its words is the number of copies expected of each of its documents. The whole part is
taken as it is; the fraction is a probability that has to become 0 or 1. Two documents at a time exchange probability,
weighed by their words, until one of them is settled: the direction is drawn so that every document keeps its
probability, and the words taken together never change. What remains of a pair meets the next document. Blocks of some 64
documents are folded in parallel, the one that remains of each goes to the next level of the tree, and the last block
of a source also holds some 256 documents held back from the start, largest first, so that what remains at the very
end is a short document. It is rounded to the nearer side, and what this is off the target is evened out by turning over
documents of the last block, largest first, as long as that brings the source closer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import WORD, materialise, partitions, unit

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, CEILING = 1.5, 2.0
BLOCK, HELD_BACK = 64, 256
SETTLED = 1e-9
SEED = 20240229

_MEMBER = "struct<order:double,draw:bigint,mark:bigint,doc_id:bigint,size:bigint,base:bigint,p:double>"
_DONE = "array<struct<doc_id:bigint,size:bigint,mark:bigint,copies:bigint>>"


def source_targets(sized: DataFrame, weights: tuple[float, ...], share: float, ceiling: float) -> DataFrame:
    """``source, source_no, source_size, target, n`` of sized rows (``source, size``).

    Sources by code point, null last, take the weights in turn. They share ``share`` times all sizes; a target above
    ``ceiling`` times its source's size is cut to that, and the rest is shared again until none is above.
    """
    spark = sized.sparkSession
    summed = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    summed = summed.repartitionByRange(partitions(spark), F.asc_nulls_last("source"))
    summed = materialise(summed.withColumn("_part", F.spark_partition_id()))
    # One row for each partition: the only window without partition.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = summed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(F.asc_nulls_last("source"))) + F.col("_before") - 1
    numbered = summed.join(parts, "_part").withColumn("source_no", place.cast("bigint"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    capped = materialise(numbered.withColumn("_weight", weight).withColumn("_cap", ceiling * F.col("source_size")))
    level, full = 0.0, -1
    while True:
        above = F.col("_cap") <= level * F.col("_weight")
        said = capped.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, F.col("_cap"))).alias("cut"),
            F.sum(F.when(~above, F.col("_weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("full"),
        ).first()
        if not said["weight"] or said["full"] == full:
            break
        full, level = said["full"], (share * said["all"] - (said["cut"] or 0.0)) / said["weight"]
    target = F.least("_cap", level * F.col("_weight"))
    return capped.select("source", "source_no", F.col("source_size").cast("bigint"), target.alias("target"), "n")


def _settled(member: Column, taken: Column) -> Column:
    copies = member["base"] + taken.cast("bigint")
    return F.struct(member["doc_id"].alias("doc_id"), member["size"].alias("size"), member["mark"].alias("mark"), copies.alias("copies"))


def _let(value: Column, then) -> Column:
    return F.transform(F.array(value), then)[0]


def _step(state: Column, new: Column) -> Column:
    """Let the member carried so far and a new one exchange probability until one of them is settled."""
    old = state["carry"]
    ratio = new["size"] / old["size"]
    can_rise = F.least(1 - old["p"], new["p"] * ratio)
    can_fall = F.least(old["p"], (1 - new["p"]) * ratio)

    def exchange(x: Column) -> Column:
        rises = unit(F.lit(SEED), old["draw"], new["draw"]) * (x["rise"] + x["fall"]) < x["fall"]
        return _let(F.struct(x["rise"].alias("rise"), x["fall"].alias("fall"), rises.alias("rises")), apply)

    def apply(x: Column) -> Column:
        change = F.when(x["rises"], x["rise"]).otherwise(-x["fall"])
        old_settled = F.when(x["rises"], x["rise"] >= 1 - old["p"]).otherwise(x["fall"] >= old["p"])
        left = F.when(old_settled, new["p"] - change / ratio).otherwise(old["p"] + change)
        carry = F.when(old_settled, new.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), left)))).otherwise(old.withField("p", left))
        done = F.when(old_settled, _settled(old, x["rises"])).otherwise(_settled(new, ~x["rises"]))
        return F.struct(carry.alias("carry"), F.concat(state["done"], F.array(done)).alias("done"))

    met = _let(F.struct(can_rise.alias("rise"), can_fall.alias("fall")), exchange)
    return F.when(old.isNull(), F.struct(new.alias("carry"), state["done"].alias("done"))).otherwise(met)


def _evened(done: Column, rest: Column, taken: Column, base: Column) -> Column:
    """The settled documents of the last block with the residual's rounding error evened out among them."""
    start = F.struct(
        ((taken.cast("double") - rest["p"]) * rest["size"]).alias("off"), F.array(_settled(rest, taken)).cast(_DONE).alias("done")
    )
    largest_first = F.array_sort(done, lambda a, b: F.when(a["size"] != b["size"], b["size"] - a["size"]).otherwise(F.when(a["mark"] < b["mark"], -1).when(a["mark"] > b["mark"], 1).otherwise(0)).cast("int"))

    def step(state: Column, d: Column) -> Column:
        up = d["copies"] <= base
        change = F.when(up, d["size"]).otherwise(-d["size"])
        closer = F.abs(state["off"] + change) < F.abs(state["off"])
        turned = d.withField("copies", d["copies"] + F.when(up, 1).otherwise(-1))
        kept = F.concat(state["done"], F.array(F.when(closer, turned).otherwise(d)))
        return F.struct((state["off"] + F.when(closer, change).otherwise(0)).alias("off"), kept.alias("done"))

    return F.aggregate(largest_first, start, step, lambda state: state["done"])


def _fold(members: DataFrame, keys: list[str], last: bool) -> tuple[DataFrame, DataFrame | None]:
    """Settle all members of a block but one, or all in the last block: the settled rows, and the rest."""
    start = F.struct(F.lit(None).cast(_MEMBER).alias("carry"), F.array().cast(_DONE).alias("done"))
    folded = members.groupBy(*keys, "source_size", "target", "n").agg(F.sort_array(F.collect_list("member")).alias("_members"))
    folded = folded.withColumn("_x", F.aggregate("_members", start, _step)).drop("_members")
    rest = F.col("_x.carry")
    taken = rest["p"] > 0.5
    if last:
        open_, done = F.lit(False), _evened(F.col("_x.done"), rest, taken, rest["base"])
    else:
        open_ = (rest["p"] > SETTLED) & (rest["p"] < 1 - SETTLED)
        done = F.when(open_, F.col("_x.done")).otherwise(F.concat("_x.done", F.array(_settled(rest, taken))))
    folded = materialise(folded.select("source_no", "source_size", "target", "n", done.alias("_done"), F.when(open_, rest).alias("member")))
    settled = folded.select("source_size", "target", F.explode("_done").alias("_d")).select("_d.*", "source_size", "target")
    return settled, None if last else folded.where("member IS NOT NULL").drop("_done")


def plan_mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, mark`` for every row of ``docs`` (``doc_id, text, source``).

    ``size`` is the number of words, 0 for a null or empty text; ``copies`` how often the mix takes the row. ``mark`` is a
    hash of doc_id and text. A document without words is taken by its probability alone. Rows that are repeated are
    documents of their own; those without source form one source. An empty table gives an empty result. All
    draws are hashes of the rows, so reruns agree.
    """
    sized = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64("doc_id", "text").alias("mark"),
    )
    # Equal rows are told apart by a number, else they would share every draw and fall into one block.
    counted = materialise(sized.groupBy("source", "doc_id", "size", "mark").agg(F.count(F.lit(1)).alias("_n")))
    targets = materialise(source_targets(counted.select("source", (F.col("size") * F.col("_n")).alias("size")), weights, share, ceiling))
    most = targets.agg(F.max("n")).first()[0] or 0
    rows = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    rows = rows.withColumn("_draw", F.xxhash64("mark", "_copy"))
    rows = rows.withColumnRenamed("source", "_source").join(targets, F.col("_source").eqNullSafe(F.col("source")))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.greatest("source_size", F.lit(1))).otherwise(0.0)
    whole = F.floor(copies + SETTLED)
    p = F.greatest(copies - whole, F.lit(0.0))
    rows = materialise(rows.withColumn("_base", whole.cast("bigint")).withColumn("_p", p))
    named = ["doc_id", "size", "mark", "copies", "source_size", "target"]
    plain = (F.col("size") == 0) | (F.col("_p") <= SETTLED)
    by_chance = F.col("_base") + (unit(F.lit(SEED + 2), F.col("_draw")) < F.col("_p")).cast("bigint")
    settled = [rows.where(plain).withColumn("copies", by_chance).select(*named)]

    member = F.struct(
        (-F.col("size")).cast("double").alias("order"), F.col("_draw").alias("draw"), "mark", "doc_id", "size",
        F.col("_base").alias("base"), F.col("_p").alias("p"),
    )
    open_rows = rows.where(~plain).withColumn("member", member.cast(_MEMBER))
    held = unit(F.lit(SEED + 3), F.col("_draw")) * F.col("n") < HELD_BACK
    keys = ["source_no", "source_size", "target", "n", "member"]
    level, size = open_rows.where(~held).select(*keys), most
    reserve = open_rows.where(held).select(*keys)
    while size > HELD_BACK:
        blocks = F.greatest(F.lit(1), F.ceil(F.least(F.col("n"), F.lit(size)) / F.lit(float(BLOCK))))
        block = F.pmod(F.xxhash64(F.lit(size), F.col("member.draw")), blocks)
        done, level = _fold(level.withColumn("_block", block), ["source_no", "_block"], last=False)
        settled.append(done.select(*named))
        size = -(-size // BLOCK)
    done, _ = _fold(level.select(*keys).union(reserve), ["source_no"], last=True)
    settled.append(done.select(*named))
    found = settled[0]
    for more in settled[1:]:
        found = found.union(more)
    return found.withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`plan_mix` takes it, with all their columns.

    Rows that agree in doc_id and text share the copies of all of them as evenly as these go.
    """
    names = docs.columns
    marked = docs.withColumn("_mark", F.xxhash64("doc_id", "text"))
    plan = plan_mix(docs, **options).groupBy(F.col("mark").alias("_m"), F.col("doc_id").alias("_id"))
    plan = materialise(plan.agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")))
    same = F.col("_mark").eqNullSafe(F.col("_m")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    joined = marked.join(plan, same)
    number = F.row_number().over(W.partitionBy("_m", "_id").orderBy(F.xxhash64(*names)))
    times = F.floor(F.col("_copies") / F.col("_rows")) + (number <= F.col("_copies") % F.col("_rows")).cast("bigint")
    taken = joined.withColumn("_times", times.cast("int")).where("_times > 0")
    return taken.withColumn("_t", F.explode(F.sequence(F.lit(1), "_times"))).select(*names)
