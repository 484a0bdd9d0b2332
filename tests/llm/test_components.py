from __future__ import annotations

import random

from helpers import roots

from tillflow.llm.components import components


def test_matches_union_find(spark):
    draw = random.Random(5)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 540)]
    nodes = {n for link in links for n in link if link[0] != link[1]}
    expected = roots(nodes, [(a, b) for a, b in links if a != b])
    found = components(spark.createDataFrame([*links, (None, 3), (7, 7)], "a bigint, b bigint"))
    assert {r["node"]: r["component"] for r in found.collect()} == expected


def test_a_star_and_no_links(spark):
    star = spark.createDataFrame([(0, i) for i in range(1, 3000)], "a bigint, b bigint")
    assert {r["component"] for r in components(star).collect()} == {0}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert components(spark.createDataFrame([(b"b", b"a")], "a binary, b binary")).count() == 2
