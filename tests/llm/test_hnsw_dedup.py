from __future__ import annotations

import numpy as np
import pytest
from helpers import roots

from tillflow.llm import hnsw_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def corpus(n=600, seed=2):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (n // 12, 24))
    spread = draw.choice([0.02, 0.15, 0.25, 0.4], n)[:, None]
    vectors = (centres[draw.integers(0, len(centres), n)] + spread * draw.normal(0, 1, (n, 24))).astype(np.float32)
    vectors[10:40] = vectors[10]
    return [(i, [float(x) for x in v], int(i % 2)) for i, v in enumerate(vectors)]


def brute(rows):
    links, ids = [], [r[0] for r in rows]
    for i, (a, v, x) in enumerate(rows):
        for b, w, y in rows[:i]:
            if x == y and x is not None and v and w and len(v) == len(w):
                one, other = np.array(v, np.float64), np.array(w, np.float64)
                size = np.sqrt((one @ one) * (other @ other))
                if size and np.isfinite(size) and one @ other / size >= 0.93:
                    links.append((a, b))
    return links, roots(ids, links)


@pytest.mark.parametrize("shard", [8192, 128])
def test_links_and_components(spark, monkeypatch, shard):
    monkeypatch.setattr(hnsw_dedup, "SHARD", shard)
    monkeypatch.setattr(hnsw_dedup, "QUERY_BLOCK", 128)
    rows = corpus()
    links, root = brute(rows)
    found = {r["vec_id"]: r for r in hnsw_dedup.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == len(rows)
    assert sum(r["n_links"] for r in found.values()) >= 0.99 * 2 * len(links)
    counts = {i: sum(i in link for link in links) for i in range(10, 40)}
    assert all(found[i]["n_links"] <= counts[i] for i in counts)
    wrong = [i for i in root if found[i]["component_id"] != root[i]]
    assert len(wrong) <= 0.01 * len(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_large_graph_recall():
    draw = np.random.default_rng(4)
    centres = draw.normal(0, 1, (300, 48))
    vectors = hnsw_dedup._unit(centres[draw.integers(0, 300, 3000)] + 0.25 * draw.normal(0, 1, (3000, 48)))
    graph = hnsw_dedup.Graph.build(vectors)
    row, place = graph.within(vectors[:800], 0.93, hnsw_dedup.BEAM, hnsw_dedup.SLACK)
    truth = vectors[:800] @ vectors.T >= 0.93
    assert len(row) == len(set(zip(row.tolist(), place.tolist(), strict=True)))
    assert truth[row, place].sum() >= 0.97 * truth.sum()


def test_single_links_beside_a_large_group(spark):
    """The links of one great group must not make up for those that pairs lack."""
    draw = np.random.default_rng(8)
    group = draw.normal(0, 1, (1, 32)) + 0.05 * draw.normal(0, 1, (1200, 32))
    singles = draw.normal(0, 1, (900, 32))
    partners = singles + 0.36 * draw.normal(0, 1, (900, 32)) * np.linalg.norm(singles, axis=1, keepdims=True) / 32**0.5
    vectors = hnsw_dedup._unit(np.concatenate([group, singles, partners])[draw.permutation(3000)])
    graph = hnsw_dedup.Graph.build(vectors)
    for at in (0, 1024, 2048):
        row, place = graph.audited(vectors[at : at + 1024], 0.93)
        truth = (vectors[at : at + 1024] @ vectors.T >= 0.93).sum(axis=1)
        few = truth < 10
        assert (truth[few] > 1).sum() > 50
        assert (np.bincount(row, minlength=len(truth))[few] >= truth[few]).mean() >= 0.995


def test_two_shards_give_a_row_for_each_class(spark):
    """A group of 1,000 near copies comes out as 1,000 rows, with the links that either direction finds."""
    draw = np.random.default_rng(5)
    group = draw.normal(0, 1, (1, 32)) + 0.05 * draw.normal(0, 1, (1000, 32))
    singles = draw.normal(0, 1, (500, 32))
    vectors = np.concatenate([group, singles, singles + 0.01]).astype(np.float32)[draw.permutation(2000)]
    shards = []
    for own in (np.arange(0, 2000, 2), np.arange(1, 2000, 2)):
        group = {name: [1] * len(own) for name in ("label", "dim", "shard", "shards")}
        group |= {"node": own, "n": own % 3 + 1, "draw": own, "vector": list(vectors[own])}
        row = hnsw_dedup._build(hnsw_dedup.pa.table(group)).to_pylist()[0]
        shards.append(hnsw_dedup.Shard(row | {"dim": 32}, ""))
    for other in (None, shards[1]):
        mine = shards[0].nodes
        nodes = mine if other is None else np.concatenate([mine, other.nodes])
        side = nodes % 2
        unit = hnsw_dedup._unit(vectors[nodes]).astype(np.float64)
        met = (unit @ unit.T >= 0.93) & (np.ones((len(nodes), len(nodes)), bool) if other is None else side[:, None] != side[None, :])
        np.fill_diagonal(met, False)
        root = roots(nodes.tolist(), [(int(nodes[a]), int(nodes[b])) for a, b in zip(*np.nonzero(met), strict=True)])
        expected = {int(x): (root[int(x)], int(met[i] @ (nodes % 3 + 1))) for i, x in enumerate(nodes) if met[i].any()}
        found, least, others = hnsw_dedup.linked_classes(shards[0], other)
        assert {int(x): (int(a), int(b)) for x, a, b in zip(found, least, others, strict=True)} == expected
        assert len(found) == len(expected)


def test_nulls_zero_repeats_and_other_columns(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (1, [1.0, 0.0], 1), (None, [3.0, 0.1], 1), (11, [1.0], 1), (12, [float("inf"), 0.0], 1)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", node string")
    found = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in hnsw_dedup.near_vectors(frame).collect())
    alone = [(str(i), 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11, 12)]
    assert found == sorted([("1", 3, 1, True), ("1", 3, 1, True), ("2", 3, 1, False), ("None", 3, 1, False), *alone])
    assert hnsw_dedup.near_vectors(frame.limit(0)).collect() == []
