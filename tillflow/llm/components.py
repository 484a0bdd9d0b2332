"""Connected components of a link table, by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbourhood."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(both.groupBy("a").agg(F.min("b").alias("_least")))
    near = both.join(least, "a")
    return near.where("b > a").select(F.col("b").alias("a"), F.least("a", "_least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of these."""
    least = materialise(links.groupBy("a").agg(F.min("b").alias("_least")))
    near = links.join(least, "a").where("b <> _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return near.union(least.select("a", F.col("_least").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.max("a")).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links (columns ``a, b`` of one orderable type, undirected).

    The component is its smallest node. Links with a null end and loops say nothing and are left out, so a node
    without another link does not appear; no links give an empty table. A node with very many links is aggregated
    before the shuffle; the minima are written before they are joined, so AQE can split such a node in the join. Rounds grow with the logarithm of the longest path; each
    is written to the shared folder.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a") != F.col("b")).alias("_x"))
    links = materialise(links.where("_x").drop("_x").distinct())
    before = _state(links)
    while before[0]:
        links = materialise(_small_star(materialise(_large_star(links))))
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
