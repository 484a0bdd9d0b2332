"""Importance resampling of documents towards a target corpus, by hashed n-gram features.

A feature is a run of 1 to ORDER words; the bucket of a feature is its CRC-32 modulo the number of buckets. A
bucket's gain is the logarithm of how much likelier it is in the target than in the documents, a document's weight the mean
gain of its features, and the documents with the highest sums of weight and Gumbel noise are a sample without
replacement in proportion to the weights.

The checksums come from position tables. CRC-32 is linear over XOR but for a constant that depends on the length, so the
checksum of a span is the XOR of what each byte contributes at its distance from the end, a table of 256 values for each
distance, and of the constant. Whole slices of texts are looked up at once and folded by ``bitwise_xor.reduceat`` over
the spans. A span longer than the table is cut into blocks from its end; the checksum of what lies before is moved
over a block by four tables of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import materialise, with_text_columns

ORDER, BUCKETS = 2, 10_000
SHARE_PERCENT, LEAST_WORDS, SEED = 25, 20, 7
BLOCK = 256  # distances from the end that the table holds
SLICE_BYTES, GROUP_BYTES = 2_000_000, 1_000_000
_POLYNOMIAL = 0xEDB88320

#: Bytes of words after A-Z are lower-cased: digits, letters and everything beyond ASCII.
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_IN_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


@lru_cache(maxsize=1)
def position_table() -> np.ndarray:
    """What a byte contributes to a checksum, by its distance from the end: ``[distance, byte]``."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, steps >> 1 ^ np.uint32(_POLYNOMIAL), steps >> 1)
    table = np.empty((BLOCK, 256), np.uint32)
    table[0] = steps
    for distance in range(1, BLOCK):
        table[distance] = table[distance - 1] >> 8 ^ steps[table[distance - 1] & 0xFF]
    return table


def _over_a_block(sums: np.ndarray) -> np.ndarray:
    """Sums of contributions as they are BLOCK bytes further from the end: a sum counts as four bytes before the block."""
    table = position_table()
    return (
        table[BLOCK - 1][sums & 0xFF]
        ^ table[BLOCK - 2][sums >> 8 & 0xFF]
        ^ table[BLOCK - 3][sums >> 16 & 0xFF]
        ^ table[BLOCK - 4][sums >> 24]
    )


@lru_cache(maxsize=1 << 16)
def _constant(length: int) -> int:
    """The checksum of ``length`` zero bytes, which contribute nothing."""
    whole, rest = divmod(length, 1 << 20)
    found = 0
    for _ in range(whole):
        found = zlib.crc32(bytes(1 << 20), found)
    return zlib.crc32(bytes(rest), found)


def _block_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The XOR of the contributions of each block's bytes, as if it were the last; GROUP_BYTES are looked up at a time."""
    sizes = ends - starts
    total = np.cumsum(sizes)
    found, row = [], 0
    while row < len(sizes):
        stop = max(row + 1, int(np.searchsorted(total, (total[row - 1] if row else 0) + GROUP_BYTES, side="right")))
        own = sizes[row:stop]
        offsets = np.cumsum(own) - own
        places = np.arange(int(own.sum()))
        distance = np.repeat(offsets + own - 1, own) - places
        shares = position_table()[distance, data[places + np.repeat(starts[row:stop] - offsets, own)]]
        found.append(np.bitwise_xor.reduceat(shares, offsets))
        row = stop
    return np.concatenate(found)


def span_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of spans of ``data``, none of them empty."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    lengths = ends - starts
    known, kind = np.unique(lengths, return_inverse=True)
    constants = np.array([_constant(n) for n in known.tolist()], np.uint32)[kind]
    # The last block ends with the span, and the first one is the short one.
    blocks = -(-lengths // BLOCK)
    first = np.cumsum(blocks) - blocks
    before = np.repeat(first + blocks - 1, blocks) - np.arange(int(blocks.sum()))
    block_ends = np.repeat(ends, blocks) - before * BLOCK
    sums = _block_sums(data, np.maximum(np.repeat(starts, blocks), block_ends - BLOCK), block_ends)
    found = sums[first]
    longer = np.flatnonzero(blocks > 1)
    for step in range(1, int(blocks.max())):
        longer = longer[blocks[longer] > step]
        found[longer] = _over_a_block(found[longer]) ^ sums[first[longer] + step]
    return found ^ constants


def word_spans(data: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of several texts, each with a blank at its end: words with one blank after each, starts, ends, text."""
    low = _LOWER[data]
    inside = _IN_WORD[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    text = np.searchsorted(text_ends, np.flatnonzero(begins), side="right")
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    joined, starts = np.where(inside, low, 32).astype(np.uint8)[keep], np.flatnonzero(begins[keep])
    return joined, starts, np.flatnonzero(~inside[keep]), text


def features(data: np.ndarray, text_ends: np.ndarray, order: int = ORDER, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every run of 1 to ``order`` words of the texts, repeats included, and the text of every word."""
    joined, starts, ends, text = word_spans(data, text_ends)
    found, owners = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for n in range(1, min(order, len(text)) + 1):
        own = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :])
        found.append(span_checksums(joined, starts[own], ends[own + n - 1]) % np.uint32(buckets))
        owners.append(text[own])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners), text


def _slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a column with a blank at the end of each, some SLICE_BYTES at a time: number, bytes, ends."""
    row, sizes = 0, np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(sizes, (sizes[row - 1] if row else 0) + SLICE_BYTES, side="right")))
        texts = column.slice(row, stop - row).fill_null("").cast(pa.large_string())
        ended = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        offsets = np.frombuffer(ended.buffers()[1], np.int64, stop - row + 1, ended.offset * 8)
        yield stop - row, np.frombuffer(ended.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]
        row = stop


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows of ``texts`` (column ``text``) fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, ends in _slices(batch.column("text")):
                total += np.bincount(features(data, ends, order, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most one row for each bucket
        found[row["bucket"]] = row["n"]
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket a thousand times the logarithm of its smoothed share in the target over that in the source."""
    more = (target + 1.0) * (float(source.sum()) + len(source))
    less = (source + 1.0) * (float(target.sum()) + len(target))
    return np.floor(1000 * np.log(more / less)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, order: int = ORDER) -> DataFrame:
    """``docs`` with ``n_words, n_features, weight``; the weight is the mean gain of the features, rounded down.

    A text that is null, empty or without a word has no features and weight 0. Columns with the added names are replaced.
    """

    def compute(column: pa.Array) -> Iterator[list[pa.Array]]:
        for size, data, ends in _slices(column):
            bucket, owner, text = features(data, ends, order, len(gain))
            n_words, n = np.bincount(text, minlength=size), np.bincount(owner, minlength=size)
            sums = np.zeros(size, np.int64)
            np.add.at(sums, owner, gain[bucket])
            yield [pa.array(c.astype(np.int64)) for c in (n_words, n, sums // np.maximum(n, 1))]

    return with_text_columns(docs, dict.fromkeys(["n_words", "n_features", "weight"], "bigint"), compute)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, drawn from a hash of the seed and the id; a null id counts as an empty text."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("bigint")


def scored(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``docs`` with ``n_words, n_features, weight, score``: two passes, one that counts features and one that weighs."""
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    return weigh(docs, gain, order).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _offsets(rows: DataFrame, drawn: int) -> DataFrame:
    """For each score among the ``drawn`` highest the number of rows above it.

    Scores are whole numbers between the bounds of weight and noise: some tens of thousands, whatever the number of rows.
    """
    sizes = rows.groupBy("score").agg(F.sum("_n").alias("_size"))
    higher = W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("score", F.coalesce(F.sum("_size").over(higher), F.lit(0)).alias("_offset"))
    return materialise(offsets.where(F.col("_offset") < drawn))


def rank_documents(docs: DataFrame, target: DataFrame, share_percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """``doc_id, mark, n_words, n_features, weight, score, rank`` for every row of ``docs`` (``doc_id, text``).

    Of the N rows with at least ``least_words`` words the floor(``share_percent`` * N / 100) with the highest scores are drawn and
    ranked from 1, ties by the smaller doc_id, then by ``mark``, a hash of id and text; the others have no rank. Repeated rows
    are documents of their own with ranks next to each other; a null doc_id comes first in a tie. An empty table gives
    an empty result, and with an empty target every bucket counts as seen once. A very long text is handled whole, a word of
    any length has its checksum, and other columns are not looked at.
    """
    columns = ["doc_id", "mark", "n_words", "n_features", "weight", "score"]
    slim = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark"))
    found = scored(slim, target, **options).select(*columns)
    rows = materialise(found.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")))
    eligible = F.col("n_words") >= least_words
    drawn = (rows.where(eligible).agg(F.sum("_n").alias("n")).first()["n"] or 0) * share_percent // 100
    offsets = _offsets(rows.where(eligible), drawn)
    lowest = offsets.agg(F.min("score")).first()[0]
    high = eligible & (F.col("score") >= lowest) if lowest is not None else F.lit(False)
    # The rows of one score are numbered on their own; the noise of the ids spreads them over the scores.
    within = W.partitionBy("score").orderBy(*columns).rowsBetween(W.unboundedPreceding, -1)
    placed = rows.where(high).join(F.broadcast(offsets), "score")
    before = F.col("_offset") + F.coalesce(F.sum("_n").over(within), F.lit(0))
    one = F.lit(1).cast("bigint")
    placed = placed.select(*columns, "_n", before.alias("_before")).unionByName(rows.where(~high).select(*columns, "_n", F.lit(drawn).cast("bigint").alias("_before")))
    copies = placed.select(*columns, "_before", F.explode(F.sequence(one, F.col("_n"))).alias("_copy"))
    rank = F.col("_before") + F.col("_copy")
    return copies.select(*columns, F.when(rank <= drawn, rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns.

    Rows that agree in id and text have one score and are drawn together; where the draw ends among them, any of them are
    taken, as many as are due.
    """
    ranked = rank_documents(docs, target, **options)
    marks = materialise(ranked.groupBy("mark").agg(F.count("rank").alias("_taken"), F.count(F.lit(1)).alias("_all")))
    mark = F.xxhash64("doc_id", "text")
    whole = marks.where("_taken = _all").select("mark")
    found = docs.join(whole, F.xxhash64(docs["doc_id"], docs["text"]) == whole["mark"], "left_semi")
    cut = marks.where("_taken > 0 AND _taken < _all").first()  # at most one
    return found if cut is None else found.unionByName(docs.where(mark == cut["mark"]).limit(cut["_taken"]))
