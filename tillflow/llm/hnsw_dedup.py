"""Near-duplicate vectors with navigable small-world graphs, one for each shard of a label.

Equal vectors of a label are one class first. The classes of a label are dealt to shards of some SHARD classes by a hash,
and every shard gets a hierarchical graph: upper layers are random samples, the lowest layer holds all classes, inserted
in batches through beam searches from the layer above, with diverse neighbours so that groups of near copies stay
reachable. Every class queries every shard of its label; two shards meet in one task, which queries both ways. A beam search
finds the neighbourhood of the query; from the vectors above the threshold the search goes on over all edges that stay above it,
so a group of any size is followed to its end. In each pair of query block and shard queries are audited against all vectors of
the shard, until LINKED of them have links or all were, and the beam is doubled until every audited query finds TARGET of its own
links. The cosines of all pairs are confirmed in double precision. Pairs stay in the task, in a table of some SHARD by SHARD bytes: out comes a row for each linked class, with its number of links and the smallest class that it reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import materialise
from tillflow.llm.components import components

THRESHOLD = 0.93
SHARD, QUERY_BLOCK = 8192, 1024
DEGREE, LOWEST_DEGREE = 16, 32  # edges that a vector gets when it is inserted, and the most it keeps
BEAM, BUILD_BEAM, AT_ONCE = 32, 48, 4
AUDITED, LINKED, TARGET = 32, 32, 0.995  # queries audited at a time, those with links that are wanted, links each has to find
FOLLOWED = 1 << 13  # pairs whose edges are followed at a time
SLACK = 0.05  # how far below the threshold the search follows edges


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def _beam(vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best vectors that a beam search finds for each query, best first (-1 where there are fewer)."""
    rows = np.arange(len(queries))[:, None]
    visited = np.zeros((len(queries), len(vectors) + 1), bool)  # the last column stands for no edge
    visited[:, -1] = True
    visited[rows, starts] = True
    ids = np.full((len(queries), width), -1)
    found = np.full((len(queries), width), -np.inf, np.float32)
    ids[:, : starts.shape[1]] = starts
    found[:, : starts.shape[1]] = np.einsum("qsd,qd->qs", vectors[starts], queries)
    open_ = ids >= 0
    active = np.arange(len(queries))
    while len(active):
        ahead = np.where(open_[active], found[active], -np.inf)
        chosen = np.argpartition(-ahead, min(AT_ONCE, width) - 1, axis=1)[:, :AT_ONCE]
        good = np.take_along_axis(ahead, chosen, axis=1) > -np.inf
        going = good.any(axis=1)
        active, chosen, good = active[going], chosen[going], good[going]
        if not len(active):
            break
        near, new = [], []
        for i in range(chosen.shape[1]):
            open_[active, chosen[:, i]] = False
            own = edges[np.where(good[:, i], ids[active, chosen[:, i]], -1)]
            own[~good[:, i]] = -1
            fresh = ~visited[active[:, None], own]
            visited[active[:, None], own] = True
            near.append(own)
            new.append(fresh)
        near, new = np.concatenate(near, axis=1), np.concatenate(new, axis=1)
        row, place = np.nonzero(new)
        score = np.full(near.shape, -np.inf, np.float32)
        score[row, place] = np.einsum("pd,pd->p", vectors[near[row, place]], queries[active[row]])
        all_ids = np.concatenate([ids[active], near], axis=1)
        all_found = np.concatenate([found[active], score], axis=1)
        all_open = np.concatenate([open_[active], new], axis=1)
        best = np.argpartition(-all_found, width - 1, axis=1)[:, :width]
        ids[active] = np.take_along_axis(all_ids, best, axis=1)
        found[active] = np.take_along_axis(all_found, best, axis=1)
        open_[active] = np.take_along_axis(all_open, best, axis=1)
    ids[found == -np.inf] = -1
    order = np.argsort(-found, axis=1)
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(found, order, axis=1)


def _diverse(vectors: np.ndarray, candidates: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, best first, those closer to the vector than to any candidate chosen before; the rest fill up."""
    out = np.full((len(candidates), most), -1)
    for at in range(0, len(candidates), 256):
        own, score = candidates[at : at + 256], scores[at : at + 256]
        near = vectors[own]
        between = near @ near.transpose(0, 2, 1)
        kept = np.zeros(own.shape, bool)
        for j in range(own.shape[1]):
            blocked = (kept & (between[:, j, :] >= score[:, j, None])).any(axis=1)
            kept[:, j] = (own[:, j] >= 0) & (score[:, j] > -np.inf) & ~blocked & (kept.sum(axis=1) < most)
        rank = np.argsort(np.where(kept, 0, np.where(own >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
        chosen = np.take_along_axis(own, rank, axis=1)
        out[at : at + 256, : chosen.shape[1]] = chosen
    return out


def _best_of_all(vectors: np.ndarray, own: np.ndarray, others: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``own`` the best of ``others`` but itself, by comparing all: for small layers and batches."""
    score = vectors[own] @ vectors[others].T
    score[own[:, None] == others[None, :]] = -np.inf
    best = np.argsort(-score, axis=1)[:, :most]
    found = np.take_along_axis(score, best, axis=1)
    return np.where(found > -np.inf, others[best], -1), found


def _add_back(vectors: np.ndarray, edges: np.ndarray, nodes: np.ndarray) -> None:
    """Give the neighbours of ``nodes`` the edge back; who has too many keeps diverse ones."""
    source = np.repeat(nodes, edges.shape[1])
    target = edges[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    score = np.einsum("pd,pd->p", vectors[source], vectors[target])
    order = np.lexsort((-score, target))
    source, target, score = source[order], target[order], score[order]
    touched, first, counts = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, counts)
    room = 2 * edges.shape[1]
    wide = np.full((len(touched), edges.shape[1] + room), -1)
    wide[:, : edges.shape[1]] = edges[touched]
    row = np.repeat(np.arange(len(touched)), counts)
    fits = place < room
    back, row, place = source[fits], row[fits], place[fits]
    known = (edges[touched[row]] == back[:, None]).any(axis=1)
    wide[row[~known], edges.shape[1] + place[~known]] = back[~known]
    scores = np.where(wide >= 0, np.einsum("tkd,td->tk", vectors[wide], vectors[touched]), -np.inf)
    order = np.argsort(-scores, axis=1)
    wide, scores = np.take_along_axis(wide, order, axis=1), np.take_along_axis(scores, order, axis=1)
    edges[touched] = _diverse(vectors, wide, scores, edges.shape[1])


class Graph:
    """Layers from the top: ``layers[i]`` holds how many of the first vectors the layer has, and their edges."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray]) -> None:
        self.vectors, self.layers = vectors, layers

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """Vectors are in random order, so the first ones of them are the upper layers."""
        sizes = [len(vectors)]
        while sizes[0] > 4 * DEGREE:
            sizes.insert(0, sizes[0] // DEGREE)
        graph = cls(vectors, [])
        for size in sizes:
            graph._layer(size)
        return graph

    def _layer(self, size: int) -> None:
        edges = np.full((len(self.vectors), LOWEST_DEGREE), -1)
        done = min(size, 4 * DEGREE)
        first = np.arange(done)
        edges[first, :DEGREE] = _diverse(self.vectors, *_best_of_all(self.vectors, first, first, BUILD_BEAM), DEGREE)
        _add_back(self.vectors, edges, first)
        upper = list(self.layers)
        while done < size:
            new = np.arange(done, min(size, 2 * done, done + 512))
            self.layers = [*upper, edges]
            starts = self._descend(self.vectors[new], done)
            near, score = _beam(self.vectors, edges, starts, self.vectors[new], BUILD_BEAM)
            also, also_score = _best_of_all(self.vectors, new, new, DEGREE)
            near, score = np.concatenate([near, also], axis=1), np.concatenate([score, also_score], axis=1)
            order = np.argsort(-score, axis=1)
            near, score = np.take_along_axis(near, order, axis=1), np.take_along_axis(score, order, axis=1)
            edges[new, :DEGREE] = _diverse(self.vectors, near, score, DEGREE)
            _add_back(self.vectors, edges, new)
            done = new[-1] + 1
        self.layers = [*upper, edges[:size]]

    def _descend(self, queries: np.ndarray, done: int) -> np.ndarray:
        """Start places in the lowest layer, found through the upper ones."""
        starts = np.zeros((len(queries), 1), int)
        for edges in self.layers[:-1]:
            found, _ = _beam(self.vectors, edges, starts, queries, 8)
            starts = np.where((found >= 0) & (found < done), found, 0)[:, :1]
        return starts

    def within(self, queries: np.ndarray, least: float, width: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, vector) with a product of at least ``least``, as far as the search meets them."""
        n, edges = len(self.vectors), self.layers[-1]
        ids, found = _beam(self.vectors, edges, self._descend(queries, n), queries, min(width, n))
        row, place = np.nonzero(found >= least - slack)
        front = row * n + ids[row, place]
        met = np.zeros(len(queries) * n, bool)
        met[front] = True
        kept = [front[found[row, place] >= least]]
        while len(front):
            ahead = []
            for at in range(0, len(front), FOLLOWED):
                part = front[at : at + FOLLOWED]
                near = edges[part % n]
                row, place = np.nonzero(near >= 0)
                pairs = np.unique((part // n)[row] * n + near[row, place])
                pairs = pairs[~met[pairs]]
                met[pairs] = True
                score = np.einsum("pd,pd->p", self.vectors[pairs % n], queries[pairs // n])
                ahead.append(pairs[score >= least - slack])
                kept.append(pairs[score >= least])
            front = np.concatenate(ahead)
        pairs = np.concatenate(kept)
        return pairs // n, pairs % n

    def audited(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`within`, with a beam that is doubled until the audited queries find what comparing all finds."""
        n, width, slack = len(self.vectors), BEAM, SLACK
        truth, linked = np.zeros(len(queries), int), 0
        order = np.argsort(np.arange(len(queries)) * 0.6180339887498949 % 1.0)  # spread over the block
        for at in range(0, len(queries), AUDITED):
            chosen = order[at : at + AUDITED]
            truth[chosen] = (queries[chosen] @ self.vectors.T >= least).sum(axis=1)
            linked += int((truth[chosen] > 1).sum())  # one may be the query itself
            if linked >= LINKED:
                break
        while True:
            row, place = self.within(queries, least, width, slack)
            if (np.bincount(row, minlength=len(queries)) >= TARGET * truth).all() or width >= n:
                return row, place
            width, slack = 2 * width, 2 * slack


def _matrix(vectors: pa.Array) -> np.ndarray:
    return np.stack(vectors.to_numpy(zero_copy_only=False)).astype(np.float32)


_KEYS = ["label", "dim", "shard", "shards"]


def _build(group: pa.Table) -> pa.Table:
    """The graph of a shard as bytes, its vectors in the order of a hash."""
    group = group.sort_by("draw")
    vectors = _matrix(group.column("vector").combine_chunks())
    layers = Graph.build(_unit(vectors)).layers
    packed = np.concatenate([np.array([len(layers), *map(len, layers)]), *[x.ravel() for x in layers]]).astype(np.int32)
    numbers = {name: group.column(name).to_numpy().astype(np.int64).tobytes() for name in ("node", "n")}
    keys = {name: group.column(name)[:1] for name in _KEYS}
    return pa.table(keys | {name: [x] for name, x in (numbers | {"vectors": vectors.tobytes(), "layers": packed.tobytes()}).items()})


class Shard:
    """A shard read back: its classes, how many rows each has, their vectors and the graph."""

    def __init__(self, row: dict, at: str) -> None:
        self.nodes, self.n = (np.frombuffer(row[name + at], np.int64) for name in ("node", "n"))
        self.vectors = np.frombuffer(row["vectors" + at], np.float32).reshape(-1, row["dim"])
        packed = np.frombuffer(row["layers" + at], np.int32).astype(np.int64)
        sizes, start, layers = packed[1 : 1 + packed[0]], 1 + packed[0], []
        for size in sizes:
            layers.append(packed[start : start + size * LOWEST_DEGREE].reshape(size, LOWEST_DEGREE))
            start += size * LOWEST_DEGREE
        self.graph = Graph(_unit(self.vectors), layers)

    def linked(self, queries: np.ndarray) -> np.ndarray:
        """A table of ``queries`` by own vectors: whether the search meets the pair and its cosine is confirmed."""
        table = np.zeros((len(queries), len(self.nodes)), bool)
        for at in range(0, len(queries), QUERY_BLOCK):
            row, place = self.graph.audited(_unit(queries[at : at + QUERY_BLOCK]), THRESHOLD - 1e-5)
            for part in range(0, len(row), 1 << 16):
                r, p = at + row[part : part + (1 << 16)], place[part : part + (1 << 16)]
                one, other = queries[r].astype(np.float64), self.vectors[p].astype(np.float64)
                cosine = np.einsum("pd,pd->p", one, other) / np.sqrt(np.einsum("pd,pd->p", one, one) * np.einsum("pd,pd->p", other, other))
                table[r, p] = cosine >= THRESHOLD
        return table


def _sums(table: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows that each line of the table is linked with; lines become numbers a few at a time."""
    return np.concatenate([table[at : at + 512] @ n.astype(np.float64) for at in range(0, len(table), 512)]).astype(np.int64)


def _reached(table: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each line and column of a table of links the first line of its component, -1 without a link."""
    lines, columns = np.full(len(table), -1), np.full(len(turned), -1)
    for first in np.flatnonzero(table.any(axis=1)):
        front = np.array([first]) if lines[first] < 0 else np.array([], int)
        lines[front] = first
        while len(front):
            near = np.flatnonzero(table[front].any(axis=0) & (columns < 0))
            columns[near] = first
            front = np.flatnonzero(turned[near].any(axis=0) & (lines < 0))
            lines[front] = first
    return lines, columns


def linked_classes(one: Shard, other: Shard | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of two shards (of one with itself, if the other is None) the classes with links, the smallest class that each

    reaches through the links between the two, and the number of rows it is linked with there. A pair found from
    either side counts, for both.
    """
    if other is None:
        table = one.linked(one.vectors)
        table |= table.T
        np.fill_diagonal(table, False)
        others, nodes = _sums(table, one.n), one.nodes
        np.fill_diagonal(table, table.any(axis=1))  # a vector is the same as line and as column
        first, _ = _reached(table, table)
    else:
        table = other.linked(one.vectors)
        table |= one.linked(other.vectors).T
        turned = np.ascontiguousarray(table.T)
        others = np.concatenate([_sums(table, other.n), _sums(turned, one.n)])
        nodes, first = np.concatenate([one.nodes, other.nodes]), np.concatenate(_reached(table, turned))
    with_links = first >= 0
    nodes, first, others = nodes[with_links], first[with_links], others[with_links]
    least = np.full(len(table), np.iinfo(np.int64).max)
    np.minimum.at(least, first, nodes)
    return nodes, least[first], others


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            x = batch.slice(i, 1).to_pylist()[0]
            nodes, least, others = linked_classes(Shard(x, ""), None if x["shard"] == x["other"] else Shard(x, "_2"))
            yield pa.RecordBatch.from_pydict({"node": nodes, "least": least, "others": others})


def usable(vector: Column) -> Column:
    """Whether a vector is there, is not zero and has finite components only."""
    inf = float("inf")
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(ok, F.lit(False))


def near_vectors(rows: DataFrame, id_name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row (columns ``vec_id, embedding, label``; others are ignored).

    Rows without label, and vectors that are null, empty, zero or hold null or non-finite components, link with nothing;
    neither do vectors of different length. Equal vectors link with each other, repeated rows included. A row without id
    takes part in links; its ``kept`` is false. An empty table gives an empty result.
    """
    rows = rows.select(F.col(id_name).cast("bigint").alias("vec_id"), F.col(vector).cast("array<float>").alias("vector"), "label")
    good = usable(F.col("vector")) & F.col("label").isNotNull()
    rows = rows.withColumn("vector", F.when(good, F.col("vector")))
    classes = rows.where("vector IS NOT NULL").groupBy("label", "vector").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = classes.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vector"))
    classes = materialise(classes.withColumn("draw", F.xxhash64("vector")))
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(SHARD))).cast("int").alias("shards"))
    dealt = classes.join(materialise(sizes), ["label", "dim"]).select("label", "dim", "node", "vector", "n", "draw", "shards")
    dealt = dealt.withColumn("shard", F.pmod("draw", "shards").cast("int"))
    parts = ["node", "n", "vectors", "layers"]
    schema = f"label {dict(rows.dtypes)['label']}, dim int, shard int, shards int, {', '.join(f'{name} binary' for name in parts)}"
    graphs = materialise(dealt.groupBy("label", "dim", "shard").applyInArrow(_build, schema))
    second = graphs.select("label", "dim", F.col("shard").alias("other"), *[F.col(name).alias(f"{name}_2") for name in parts])
    pairs = graphs.withColumn("other", F.explode(F.sequence("shard", F.col("shards") - 1))).join(second, ["label", "dim", "other"])
    pairs = pairs.repartition("label", "dim", "shard", "other").drop("label", "shards")
    links = materialise(pairs.mapInArrow(_search, "node bigint, least bigint, others bigint"))

    linked = links.groupBy("node").agg(F.sum("others").alias("_others"))
    found = components(links.select(F.col("node").alias("a"), F.col("least").alias("b")))
    named = classes.select("label", "vector", "n", "least", "node").join(linked, "node", "left").join(found, "node", "left")
    named = materialise(named.withColumn("root", F.coalesce("component", "node")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(
        "label", "vector", "component_id", (F.coalesce("_others", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    out = rows.join(materialise(named), ["label", "vector"], "left")
    component = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
