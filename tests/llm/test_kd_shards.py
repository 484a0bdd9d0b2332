from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest
from helpers import documents, frame

from tillflow.llm import kd_shards


def corpus(n, seed=1):
    draw = random.Random(seed)
    return [(i, "x" * draw.choice([5, 50, 50, 700, 2000]), draw.choice(["en", "de"]), draw.choice(["hot"] * 5 + ["a", "b", None]), 0) for i in range(n)]


@pytest.mark.parametrize(("n", "shards"), [(1500, 16), (200, 5)])
def test_shards_have_nearly_equal_bytes(spark, n, shards):
    rows = corpus(n)
    found = kd_shards.plan_shards(frame(spark, rows), shards=shards).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(n))
    total, slots = defaultdict(int), defaultdict(list)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        assert r["size"] == len(texts[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(total) == set(range(shards))
    assert max(total.values()) - min(total.values()) <= 2 * 2001
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_cells_follow_the_widest_dimension(spark):
    """Two languages of equal weight: the first cut parts them."""
    rows = [(i, "x" * 99, "en" if i % 2 else "zz", "s", 0) for i in range(400)]
    found = kd_shards.plan_shards(frame(spark, rows), shards=2).collect()
    assert {(r["doc_id"] % 2, r["shard"]) for r in found} == {(1, 0), (0, 1)}


def test_values_with_a_common_beginning_are_parted(spark):
    rows = [(i, "x" * 99, "en", f"https://site.example/{i % 4:02}", 0) for i in range(400)]
    found = kd_shards.plan_shards(frame(spark, rows), shards=4).collect()
    assert {(r["doc_id"] % 4, r["shard"]) for r in found} == {(i, i) for i in range(4)}


def test_ranks_are_in_the_order_of_bytes(spark):
    values = ["", "b", "a", "ä", "z", "aa", "😀", "Z", None, "a"]
    found = kd_shards.value_ranks(frame(spark, [(i, "x", "en", v, 0) for i, v in enumerate(values)]).repartition(4), "source")
    expected = sorted({v for v in values if v is not None}, key=str.encode)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == [(v, i + 1) for i, v in enumerate(expected)]


def test_target_bytes(spark):
    found = kd_shards.plan_shards(frame(spark, corpus(300)), target_bytes=60_000)
    sizes = [r[1] for r in found.groupBy("shard").sum("size").collect()]
    assert max(sizes) <= 60_000 + 2001 and min(sizes) > 30_000


def test_reruns_agree(spark):
    docs = frame(spark, corpus(500))
    assert sorted(kd_shards.plan_shards(docs, shards=8).collect()) == sorted(kd_shards.plan_shards(docs.repartition(3), shards=8).collect())


def test_nulls_repeats_and_few_rows(spark):
    rows = [(1, "same", "en", "s", 0)] * 900 + [(None, None, None, None, None)] * 2 + [(2, "", "en", "s", 0)]
    found = kd_shards.plan_shards(frame(spark, rows), shards=4).collect()
    assert len(found) == 903 and {r["size"] for r in found if r["doc_id"] != 1} == {1}
    sizes = [sum(r["size"] for r in found if r["shard"] == s) for s in range(4)]
    assert max(sizes) - min(sizes) <= 10
    assert kd_shards.plan_shards(frame(spark, []), shards=4).collect() == []
    assert len(kd_shards.plan_shards(documents(spark, "a"), shards=16).collect()) == 1


def test_rows_with_their_places(spark):
    docs = frame(spark, [*corpus(50), (7, "twice", "en", "s", 1), (7, "twice", "de", "s", 2)]).withColumnRenamed("n_chars", "slot")
    found = kd_shards.shard(docs, shards=3)
    assert found.columns == ["doc_id", "text", "lang", "source", "shard", "slot"]
    assert found.count() == 52 and found.select("shard", "slot").distinct().count() == 52


def test_many_rows_in_a_shard_are_numbered_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(kd_shards, "SLOT_ROWS", 7)
    found = kd_shards.plan_shards(frame(spark, corpus(300)), shards=2).collect()
    for s in (0, 1):
        own = sorted(r["slot"] for r in found if r["shard"] == s)
        assert own == list(range(len(own)))
