from __future__ import annotations

import math
import random

import pytest
from conftest import rows

from tillflow.operators.ranking import quantile_by


def plain(points: list[tuple], percent: int) -> list[tuple]:
    groups: dict = {}
    for key, value in points:
        if key is not None and value is not None:
            groups.setdefault(key, []).append(value)
    return sorted((k, sorted(v)[max(math.ceil(len(v) * percent / 100), 1) - 1]) for k, v in groups.items())


@pytest.mark.parametrize("percent", [1, 50, 95, 100])
def test_quantiles_of_hot_groups_are_exact(spark, percent):
    """One group holds most rows and is cut into ranges several times; values repeat, and some groups are tiny."""
    pick = random.Random(percent)
    points = [("hot", pick.gauss(0, 1000) if i % 3 else 7.0) for i in range(20_000)]
    points += [("same", 1.5)] * 3000 + [("one", -2.0), (None, 1.0), ("none", None), ("pair", 1.0), ("pair", 2.0)]
    frame = spark.createDataFrame(points, "k string, v double")
    assert sorted(rows(quantile_by(frame, "k", "v", percent, most=20))) == plain(points, percent)
    assert sorted(rows(quantile_by(frame, "k", "v", percent))) == plain(points, percent)


def test_quantiles_of_an_empty_frame_and_of_other_types(spark):
    assert quantile_by(spark.createDataFrame([], "k string, v double"), "k", "v", 95).count() == 0
    points = [(1, i * i) for i in range(500)]
    assert rows(quantile_by(spark.createDataFrame(points, "k int, v bigint"), "k", "v", 95, most=3)) == plain(points, 95)
    odd = [(1, v) for v in (float("inf"), float("-inf"), float("nan"), 1.0, 2.0, 3.0)] * 3
    assert rows(quantile_by(spark.createDataFrame(odd, "k int, v double"), "k", "v", 50, most=1)) == [(1, 2.0)]


def test_no_task_sorts_a_large_group(spark):
    """The window sorts what is left of a group: far fewer rows than the group has values."""
    frame = spark.range(50_000).selectExpr("1 AS k", "CAST(hash(id) AS double) AS v")
    found = quantile_by(frame, "k", "v", 95, most=100)
    files = [f for f in found.inputFiles()]
    left = spark.read.parquet(*{f.rpartition("/")[0] for f in files if f.endswith(".parquet")}).count()
    assert left < 1000
