"""RANK() over a whole table, and quantiles of large groups, without moving the table or a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.session import stage

MAX_BUCKETS = 4096
CHUNK = 64
RANGES = 64
#: Distinct values of a group that one task sorts.
MAX_SORTED = 100_000


def _above(bounds: Column, value: Column) -> Column:
    return F.array_size(F.filter(bounds, lambda bound: value.cast("double") < bound))


def _bucket(value: Column, bounds: list[float]) -> Column:
    """A number that falls as the value rises: 0 for the highest values, equal for equal values, last for nulls.

    The sorted bounds are looked up in two steps, the chunk first and then the place in the chunk, so that
    thousands of bounds cost some hundred comparisons.
    """
    if not bounds:
        return F.lit(0)
    chunks = [bounds[i : i + CHUNK] for i in range(0, len(bounds), CHUNK)]
    higher_chunks = _above(F.array(*[F.lit(chunk[0]) for chunk in chunks]), value)
    own_chunk = F.try_element_at(
        F.array(*[F.array(*[F.lit(b) for b in chunk]) for chunk in chunks]), F.lit(len(chunks)) - higher_chunks
    )
    within = F.when(higher_chunks == len(chunks), 0).otherwise(_above(own_chunk, value))
    return F.when(value.isNull(), (len(chunks) + 1) * CHUNK).otherwise(higher_chunks * CHUNK + within)


def _ranks(df: DataFrame, value: str, bounds: list[float]) -> DataFrame:
    """Each distinct value with its descending rank.

    Values are counted first, so ties cost nothing however many rows share a value. The distinct values are
    cut into buckets by value range; a rank is the number of rows in higher buckets plus the number of rows
    with a higher value in the same bucket, plus one.
    """
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")).withColumn("_bucket", _bucket(F.col(value), bounds))
    higher = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    # At most MAX_BUCKETS + 2 rows: the one window without partition, and small enough to broadcast.
    offsets = (
        counted.groupBy("_bucket")
        .agg(F.sum("_n").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(higher), F.lit(0)).alias("_offset"))
    )
    inside = W.partitionBy("_bucket").orderBy(F.desc(value)).rowsBetween(W.unboundedPreceding, -1)
    ahead = counted.withColumn("_ahead", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return ahead.join(F.broadcast(offsets), "_bucket").select(
        F.col(value).alias("_value"), (F.col("_offset") + F.col("_ahead") + 1).alias("_rank")
    )


def rank_descending(df: DataFrame, ranks: dict[str, str]) -> DataFrame:
    """Add rank columns, given as {rank column: numeric column}. Ties share a rank and leave a gap.

    The bucket bounds come from one pass over ``df`` for approximate quantiles; they only balance the work,
    every rank is exact. Pass a frame that is cheap to read twice (a table or a checkpoint).
    """
    buckets = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    probabilities = [i / buckets for i in range(1, buckets)]
    values = list(dict.fromkeys(ranks.values()))
    quantiles = df.approxQuantile(values, probabilities, 0.5 / buckets) if probabilities else [[] for _ in values]
    bounds = {value: sorted(set(found)) for value, found in zip(values, quantiles, strict=True)}
    ranked = df
    for name, value in ranks.items():
        found = _ranks(df, value, bounds[value]).withColumnRenamed("_rank", name)
        ranked = ranked.join(found, ranked[value].eqNullSafe(found["_value"]), "left").drop("_value")
    return ranked


def _placed_by_range(counted: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The values of the one range of each group that holds the place ``_wanted``, and the place counted from its start.

    Ranges are cut at approximate quantiles of the distinct values, which only balance the work. Neither frame is computed
    yet; sums run over at most ``RANGES + 1`` rows of a group.
    """
    cuts = [i / RANGES for i in range(1, RANGES)]
    bounds = counted.groupBy(key).agg(F.percentile_approx("_value", cuts, 1000).alias("_bounds"))
    placed = counted.join(bounds, key).withColumn("_range", F.size(F.filter("_bounds", lambda b: b < F.col("_value")))).drop("_bounds")
    sizes = placed.groupBy(key, "_range").agg(F.sum("_n").alias("_size"))
    before = F.sum("_size").over(W.partitionBy(key).orderBy("_range")) - F.col("_size")
    left = sizes.withColumn("_before", before).join(wanted, key)
    hit = left.filter((F.col("_before") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_before") + F.col("_size")))
    hit = stage(hit.select(key, "_range", (F.col("_wanted") - F.col("_before")).alias("_wanted")))
    return placed.join(hit.select(key, "_range"), [key, "_range"], "left_semi").drop("_range"), hit.drop("_range")


def quantile_by(df: DataFrame, key: str, value: str, percent: int, most: int = MAX_SORTED) -> DataFrame:
    """``key, quantile``: per group the least value that ``percent`` of 100 rows do not exceed, exactly. Nulls do not count.

    Rows are counted by value first, so ties cost nothing. While a group has more than ``most`` distinct values, each group
    is cut into ranges and only the range that holds the wanted place stays, so no task sorts the values of a large group.
    Groups whose key is null are left out.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    counted = stage(rows.groupBy(key, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n")))
    places = F.ceil(F.sum("_n") * percent / F.lit(100).cast("decimal(3,0)")).cast("bigint")
    wanted = counted.groupBy(key).agg(F.greatest(places, F.lit(1)).alias("_wanted"))

    def largest(frame: DataFrame) -> int:
        return frame.groupBy(key).count().agg(F.max("count")).first()[0] or 0

    size = largest(counted)
    while size > most:
        counted, wanted = _placed_by_range(counted, wanted, key)
        counted = stage(counted)
        size, previous = largest(counted), size
        if size == previous:
            break
    upto = F.sum("_n").over(W.partitionBy(key).orderBy("_value"))
    reached = counted.withColumn("_upto", upto).join(wanted, key).filter(F.col("_upto") >= F.col("_wanted"))
    return reached.groupBy(key).agg(F.min("_value").alias("quantile"))
