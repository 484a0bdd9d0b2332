"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash signatures, confirmed on full shingle sets.

A signature has 45 places of 11 bits: the lowest bits kept of 45 minimum hashes of a document's shingles. Two documents
differ in a place with probability 1 - J. The places form 9 chunks of 5. By the pigeonhole principle, documents
that differ in at most 15 places have two chunks with at most one error each; every document is therefore filed under
the five ways of leaving out one place of each chunk, 45 keys, and all pairs within that distance meet under a key. Pairs
further apart meet less surely: at J = 0.75 a pair fails to meet under any key with probability 0.00012.

Pairs that meet are compared on full sets unless they differ in more than 26 places (at J = 0.75 with probability 0.000001) or
their parity sketches rule them out. A sketch has a bit for each of 768 classes of shingles, set if the document has an odd
number of them. A shingle that one of two documents lacks turns one bit over, so they differ in at least as many shingles as
their sketches differ in bits, and more than a seventh of both sizes is too many for the share: nothing true is lost.

No key emits all its pairs. Documents with equal sets are one class first. In a first round each class is compared with
the class of its key that meets most others, usually the text that the copies were made of, which joins a group of
any size by a linear number of pairs. Classes whose components still differ are then compared under each key that
holds more than one component: those outside its most frequent component with the rest, however many they are; sizes,
places and sketches rule pairs out inside the join, and AQE splits a key that holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import SLICE_ROWS, WORD, WordHashes, materialise, mixed, words
from tillflow.llm.components import components

SHINGLE = 5
SHARE = 75  # per cent of the union that the intersection must reach
CHUNKS, WIDTH = 9, 5
PLACES = CHUNKS * WIDTH
MOST_ERRORS = 26
SKETCH = 12  # numbers of 64 bits
#: A number holds the places of a chunk, 12 bits each with the highest left clear; its guards are those highest bits.
BITS = 11
GUARDS = sum(1 << (12 * i + BITS) for i in range(WIDTH))
ONES = sum(((1 << BITS) - 1) << (12 * i) for i in range(WIDTH))
LONG = 1 << 15  # shingles hashed at a time

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(0, 1 << 63, PLACES, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_ORDER = np.array([pow(0x9E3779B97F4A7C15, SHINGLE - 1 - i, 1 << 64) for i in range(SHINGLE)], dtype=np.uint64)
_SHIFTS = np.arange(WIDTH, dtype=np.uint64) * np.uint64(12)
_PRINT = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes: five words each, the whole sequence if there are fewer, none without words."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    codes = np.fromiter((hashes[w] for w in found), np.uint64, len(found))
    if len(codes) < SHINGLE:
        return mixed(np.array([(codes * _ORDER[: len(codes)]).sum() + np.uint64(len(codes))], np.uint64))
    n = len(codes) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        total += codes[i : i + n] * _ORDER[i]
    return np.unique(mixed(total))


def _signature(own: np.ndarray) -> np.ndarray:
    """The places, a chunk to a number, then the parity sketch."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), LONG):
        np.minimum(least, (own[None, at : at + LONG] * _FACTORS[:, None]).min(axis=1), out=least)
    places = mixed(least) & np.uint64((1 << BITS) - 1)
    numbers = (places.reshape(CHUNKS, WIDTH) << _SHIFTS).sum(axis=1, dtype=np.uint64).view(np.int64)
    classes = ((own >> np.uint64(32)) % np.uint64(64 * SKETCH)).astype(np.int64)
    odd = np.packbits((np.bincount(classes, minlength=64 * SKETCH) & 1).astype(np.uint8))
    return np.concatenate([numbers, odd.view(np.int64)])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's columns but the text, with size, node and signature of its shingle set."""
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            sizes, nodes, signatures = [], [], []
            for text in part.column("text"):
                own = shingles(text.as_py(), hashes)
                sizes.append(len(own))
                node = (len(own), int(mixed(own).sum()), int(mixed(own * _PRINT).sum())) if len(own) else None
                nodes.append(node and b"".join(n.to_bytes(w, "big") for n, w in zip(node, (4, 8, 8), strict=True)))
                signatures.append(_signature(own) if len(own) else None)
            added = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.list_(pa.int64()))]
            kept = [name for name in part.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*[part.column(name) for name in kept], *added], [*kept, "n_shingles", "node", "signature"])


def _keys(places: np.ndarray) -> np.ndarray:
    """For each row of places its keys. The lowest four bits are the chunk, the next three the place left out."""
    spread = mixed(places + (np.arange(PLACES, dtype=np.uint64) << np.uint64(20)))
    chunks = spread.reshape(-1, CHUNKS, WIDTH)
    left_out = np.arange(WIDTH, dtype=np.uint64)
    keys = mixed(chunks.sum(axis=2, dtype=np.uint64)[:, :, None] - chunks + left_out) & ~np.uint64(127)
    keys |= left_out << np.uint64(4) | np.arange(CHUNKS, dtype=np.uint64)[:, None]
    return keys.reshape(len(places), PLACES)


def _places(signatures: pa.Array) -> np.ndarray:
    numbers = signatures.flatten().to_numpy().view(np.uint64).reshape(-1, CHUNKS + SKETCH, 1)[:, :CHUNKS]
    return (numbers >> _SHIFTS & np.uint64((1 << BITS) - 1)).reshape(-1, PLACES)


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _keys(_places(batch.column("signature"))).view(np.int64)
        nodes = batch.column("node").take(pa.array(np.repeat(np.arange(batch.num_rows), PLACES)))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), nodes], ["key", "node"])


def _errors(one: str, other: str, chunk: int) -> Column:
    """Places of a chunk that differ: each carries into the guard above it."""
    apart = F.col(one)[chunk].bitwiseXOR(F.col(other)[chunk])
    return F.bit_count((apart + F.lit(ONES)).bitwiseAND(F.lit(GUARDS)))


def _first_meeting(one: str, other: str) -> Column:
    """Whether no earlier key brings the pair together: of a chunk's keys all match, or one."""
    chunk, left_out = F.col("key").bitwiseAND(15), F.shiftright("key", 4).bitwiseAND(7)
    known = F.lit(False)
    for i in range(CHUNKS):
        here = (_errors(one, other, i) > 0) | (left_out == 0)
        for before in range(i):
            here = here & (_errors(one, other, before) > 1)
        known = F.when(chunk == i, here).otherwise(known)
    return known


def _may_link(one: str, n: str, other: str, m: str) -> Column:
    """Whether two sizes allow the share and the signatures and sketches differ little enough."""
    errors = sum((_errors(one, other, i) for i in range(1, CHUNKS)), _errors(one, other, 0))
    turned = F.lit(0)
    for i in range(CHUNKS, CHUNKS + SKETCH):
        turned = turned + F.bit_count(F.col(one)[i].bitwiseXOR(F.col(other)[i]))
    # Of a union u the intersection i has the share s, so both sizes are u + i and u - i may be (1 - s) / (1 + s) of them.
    few = turned * (100 + SHARE) <= (F.col(n) + F.col(m)) * (100 - SHARE)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * SHARE) & few & (errors <= MOST_ERRORS)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, kept = WordHashes(), (None, None)
    for batch in batches:
        a, b, verdicts = batch.column("a"), batch.column("b"), []
        for i in range(batch.num_rows):
            node = b[i].as_py()
            if kept[0] != node:
                kept = node, shingles(batch.column("text_b")[i].as_py(), hashes)
            one, other = shingles(batch.column("text")[i].as_py(), hashes), kept[1]
            common = len(np.intersect1d(one, other, assume_unique=True))
            verdicts.append(100 * common >= SHARE * (len(one) + len(other) - common))
        yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(verdicts, pa.bool_()))


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text is one of their class: a doc_id may stand on rows with different texts."""
    for batch in batches:
        if batch.num_rows:
            found = pa.Table.from_batches(_sign(iter([batch.select(["text"])]))).column("node").combine_chunks()
            same = pa.array([a == b for a, b in zip(found.to_pylist(), batch.column("node").to_pylist(), strict=True)])
            yield batch.select(["node", "text"]).filter(same)


def _links(near: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that truly link, by their texts."""
    with_a = near.join(texts.withColumnRenamed("node", "a"), "a")
    with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return materialise(with_b.select("a", "b", "text", "text_b").mapInArrow(_confirm, "a binary, b binary"))


def _outside(filed: DataFrame) -> DataFrame:
    """Rows of the keys with more than one component, ``top`` the most frequent one and ``outside`` the rows beside it."""
    counted = filed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_n"))
    keys = counted.groupBy("key").agg(
        F.max_by("component", F.struct("_n", "component")).alias("top"), (F.sum("_n") - F.max("_n")).alias("outside")
    )
    return filed.join(materialise(keys.where("outside > 0")), "key")


def _across(rows: DataFrame) -> DataFrame:
    """Pairs of different components under a key that may link: each class outside the top component with the others.

    A pair is given by the first of the keys that it shares.
    """
    other = [F.col(c).alias(f"_{c}") for c in ("node", "component", "signature", "n_shingles")]
    outside = rows.where("component <> top").select("key", *other)
    parts = (F.col("component") != F.col("_component")) & ((F.col("component") == F.col("top")) | (F.col("node") < F.col("_node")))
    near = parts & _may_link("signature", "n_shingles", "_signature", "_n_shingles")
    met = outside.join(rows, "key").where(near & _first_meeting("signature", "_signature"))
    return met.select(F.greatest("_node", "node").alias("a"), F.least("_node", "node").alias("b"))


def _grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, n_shingles, root, component_id`` of every row; ``mark`` is a hash of doc_id and text."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked = docs.withColumn("mark", F.xxhash64("doc_id", "text"))
    signed = materialise(marked.mapInArrow(_sign, "doc_id bigint, mark bigint, n_shingles bigint, node binary, signature array<bigint>"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark"))
    classes = materialise(
        signed.where("n_shingles > 0")
        .groupBy("node")
        .agg(first.alias("_f"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
        .select("node", "signature", "n_shingles", F.col("_f.doc_id").alias("first_id"), F.col("_f.mark").alias("first_mark"))
    )
    filed = classes.select("node", "signature").mapInArrow(_file, "key bigint, node binary")
    shared = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Counted on its own, so that the join has no aggregate on its key and AQE can split a hot one.
    filed = materialise(filed.join(materialise(shared), "key"))
    met = materialise(filed.groupBy("node").agg(F.sum("n").alias("met")))
    filed = materialise(filed.join(met, "node").select("key", "node", "met"))

    wanted = classes.join(filed.select("node").distinct(), "node", "left_semi").select("node", "first_mark")
    texts = marked.join(wanted, F.col("mark") == F.col("first_mark")).select("node", "text")
    texts = materialise(texts.mapInArrow(_own_text, "node binary, text string").dropDuplicates(["node"]))

    leaders = filed.groupBy("key").agg(F.max(F.struct("met", "node")).alias("_l")).select("key", F.col("_l.node").alias("b"))
    led = filed.join(materialise(leaders), "key").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    one = classes.select(F.col("node").alias("a"), "signature", "n_shingles")
    other = classes.select(F.col("node").alias("b"), F.col("signature").alias("_signature"), F.col("n_shingles").alias("_n"))
    led = led.join(one, "a").join(other, "b").where(_may_link("signature", "n_shingles", "_signature", "_n"))
    led = materialise(led.select("a", "b"))
    grouped = materialise(components(_links(led, texts)))

    labelled = filed.join(grouped, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    signatures = classes.select("node", "signature", "n_shingles")
    several = materialise(_outside(materialise(labelled)).join(signatures, "node"))
    pairs = _across(several).distinct()
    compared = led.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    second = _links(materialise(pairs.join(compared, ["a", "b"], "left_anti")), texts)

    ends = second.join(grouped.select(F.col("node").alias("a"), F.col("component").alias("_a")), "a", "left")
    ends = ends.join(grouped.select(F.col("node").alias("b"), F.col("component").alias("_b")), "b", "left")
    ends = ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    joined = materialise(components(ends)).select(F.col("node").alias("component"), F.col("component").alias("_last"))

    labelled = classes.select("node", "first_id").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = materialise(labelled.join(joined, "component", "left").select("node", "first_id", F.coalesce("_last", "component").alias("root")))
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialise(labelled.join(least, "root").select("node", "root", "component_id"))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return signed.join(named, "node", "left").select("doc_id", "mark", "n_shingles", "root", own.alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (columns ``doc_id, text``; others are ignored).

    Null and empty texts have no shingles, link with nothing and are their own component. Rows with equal shingle sets
    are of one component, repeated rows included. A row without doc_id takes part in links; its ``kept`` is false, and its
    component is null only if no document of the component has an id. An empty table gives an empty result.
    """
    found = _grouped(docs)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of every group of near copies, that of the smallest doc_id, with all columns; rows without words stay.

    A group whose rows all lack a doc_id keeps one of them, and of rows that agree in doc_id and text one stays.
    """
    names = docs.columns
    found = _grouped(docs).where("root IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark"))
    marks = found.groupBy("root").agg(first.alias("_first")).select(F.col("_first.mark").alias("_m"))
    marked = docs.withColumn("_mark", F.xxhash64(F.col("doc_id").cast("bigint"), "text"))
    worded = F.coalesce(F.rlike("text", F.lit(WORD)), F.lit(False))
    number = F.row_number().over(W.partitionBy("_m").orderBy(F.xxhash64(*names)))
    kept = marked.where(worded).join(materialise(marks.distinct()), F.col("_mark") == F.col("_m")).withColumn("_number", number)
    return kept.where("_number = 1").select(*names).union(docs.where(~worded))
