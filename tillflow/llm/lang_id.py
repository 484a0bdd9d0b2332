"""Language of texts: an interpolated Kneser-Ney model of character four-grams for each language.

A text becomes a sequence of lower-case letters and single blanks. The language whose model gives the lowest cross-entropy
per symbol is chosen. Models are fitted on a bounded sample, SAMPLE documents of each label by the order of a hash of their
id: four fifths give the counts, one fifth the distribution of cross-entropies from which the rejection
threshold of each language is taken. Counting runs in Spark; the counts of the sample make the tables.

The tables hold, for every n-gram that any language has seen, the finished log-probability in each language, in one
array sorted by hash with an index on the leading bits. Only an n-gram that no language has seen is put together from
the weight of its context and the next lower order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.common import mixed, unit

ORDER = 4
SAMPLE = 3000  # documents of each language that the model is fitted on, on average
PART = 1_000_000  # symbols handled at a time; a longer text is read in parts that go on with the symbols before them
SHARPNESS = 8.0
UNDETERMINED = "und"
_PAD, _BLANK, _OTHER = 1, 32, 2
_BITS = np.uint64(16)


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """For every code point of the basic plane: the lower-case letter, or a blank for all that is not a letter."""
    found = np.full(1 << 16, _BLANK, np.uint16)
    for code in range(1 << 16):
        letter = chr(code)
        if letter.isalpha():
            low = letter.lower()
            found[code] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else code
    return found


def _text_symbols(text: str, before: np.ndarray | None = None) -> np.ndarray:
    """Letters and single blanks of a text, after ORDER - 1 pads. Letters beyond the basic plane are one symbol.

    For a later part of a text ``before`` has the last ORDER - 1 symbols of the part before it, in the place of the pads.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = _symbols()[np.minimum(codes, 0xFFFF)]
    if len(codes) and codes.max() > 0xFFFF:
        for code in np.unique(codes[codes > 0xFFFF]):
            found[codes == code] = _OTHER if chr(code).isalpha() else _BLANK
    blank = found == _BLANK
    keep = np.ones(len(blank), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    if before is None:
        before = np.full(ORDER - 1, _PAD, np.uint16)
    elif len(found) and before[-1] == _BLANK:
        keep[0] = found[0] != _BLANK
    return np.concatenate([before, found[keep]])


def _grams(symbols: np.ndarray) -> np.ndarray:
    """Each symbol with the three before it, packed."""
    wide = symbols.astype(np.uint64)
    found = wide[: -(ORDER - 1)]
    for i in range(1, ORDER):
        found = found << _BITS | wide[i : len(wide) - ORDER + 1 + i]
    return found


def _parts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of some PART symbols: row of each text part, its number of grams, all grams."""
    rows, counts, grams, total = [], [], [], 0
    for row, text in enumerate(texts):
        before = None
        for at in range(0, len(text or ""), PART):
            symbols = _text_symbols(text[at : at + PART], before)
            own, before = _grams(symbols), symbols[1 - ORDER :]
            if not len(own):
                continue
            rows.append(row)
            counts.append(len(own))
            grams.append(own)
            total += len(own)
            if total >= PART:
                yield np.array(rows), np.array(counts), np.concatenate(grams)
                rows, counts, grams, total = [], [], [], 0
    if rows:
        yield np.array(rows), np.array(counts), np.concatenate(grams)


class HashTable:
    """Rows of numbers by key: keys in an array sorted by hash, found through an index on the leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        hashes = mixed(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)
        self.shift = np.uint64(64 - max(1, len(keys).bit_length()))
        starts = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.first = np.searchsorted(self.hashes, starts).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        hashes = mixed(keys)
        found = np.full(len(keys), -1, np.int32)
        at = self.first[(hashes >> self.shift).astype(np.int64)]
        open_ = np.arange(len(keys))
        while len(open_):
            inside = at < len(self.hashes)
            open_, at, hashes = open_[inside], at[inside], hashes[inside]
            there = self.hashes[at]
            hit = there == hashes
            found[open_[hit]] = at[hit]
            more = there < hashes
            open_, at, hashes = open_[more], at[more] + 1, hashes[more]
        return found


class _Language:
    """Counts of one language and its interpolated probabilities, used while the tables are made."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.levels = {}
        for k in range(ORDER, 0, -1):
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            once, twice = int((counts == 1).sum()), int((counts == 2).sum())
            discount = once / (once + 2 * twice) if once and twice else 0.75
            contexts, place, types = np.unique(keys >> _BITS, return_inverse=True, return_counts=True)
            self.levels[k] = keys, counts, discount, contexts, np.bincount(place, counts), types
            keys, counts = np.unique(keys & np.uint64((1 << 16 * (k - 1)) - 1), return_counts=True)

    @staticmethod
    def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def weight(self, k: int, contexts: np.ndarray) -> np.ndarray:
        """What the next lower order counts for after a context; one where the context is new."""
        _, _, discount, known, sums, types = self.levels[k]
        at, found = self._at(known, contexts)
        return np.where(found, discount * types[at] / sums[at], 1.0)

    def probability(self, k: int, keys: np.ndarray, size: int) -> np.ndarray:
        known, counts, discount, contexts, sums, _ = self.levels[k]
        at, found = self._at(known, keys)
        place, seen = self._at(contexts, keys >> _BITS)
        own = np.where(found & seen, (counts[at] - discount) / sums[place], 0.0)
        below = self.probability(k - 1, keys & np.uint64((1 << 16 * (k - 1)) - 1), size) if k > 1 else 1.0 / size
        return own + self.weight(k, keys >> _BITS) * below


@dataclass
class Model:
    languages: list[str]
    grams: dict[int, HashTable]  # of order 1 to ORDER: log-probabilities
    weights: dict[int, HashTable]  # of contexts of order 1 to ORDER: log-weights
    floor: float
    limits: np.ndarray  # cross-entropy above which a text is rejected

    def _log(self, k: int, keys: np.ndarray) -> np.ndarray:
        if not k:
            return np.full((len(keys), len(self.languages)), self.floor, np.float32)
        at = self.grams[k].find(keys)
        found = self.grams[k].values[at]
        missing = np.flatnonzero(at < 0)
        if len(missing):
            kinds, back = np.unique(keys[missing], return_inverse=True)
            below = self._log(k - 1, kinds & np.uint64((1 << 16 * (k - 1)) - 1))
            place = self.weights[k].find(kinds >> _BITS)
            found[missing] = (below + np.where(place[:, None] < 0, 0.0, self.weights[k].values[place]))[back]
        return found

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol of each text in each language, and whether the text has a letter."""
        sums, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        letters = np.zeros(len(texts), bool)
        for rows, sizes, grams in _parts(texts):
            starts = np.cumsum(sizes) - sizes
            np.add.at(sums, rows, np.add.reduceat(self._log(ORDER, grams), starts, axis=0, dtype=np.float64))
            np.add.at(counts, rows, sizes)
            letter = (grams & np.uint64(0xFFFF)) != np.uint64(_BLANK)
            np.logical_or.at(letters, rows, np.logical_or.reduceat(letter, starts))
        return -sums / np.maximum(counts, 1)[:, None], letters

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each text."""
        found, letters = self.entropies(texts)
        best = found.argmin(axis=1)
        lowest = found[np.arange(len(texts)), best]
        score = np.where(letters, 1 / np.exp(SHARPNESS * (lowest[:, None] - found)).sum(axis=1), 0.0)
        named = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)]
        return named, score, lowest, ~letters | (lowest > self.limits[best])


def _sampled(labelled: DataFrame) -> tuple[DataFrame, list[str]]:
    """Some SAMPLE documents of each language, all of a smaller one, as ``_language, _fit, text``."""
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(sizes)
    place = F.lit(None).cast("int")
    share = F.lit(0.0)
    for i, name in enumerate(names):
        place = F.when(F.col("lang") == name, i).otherwise(place)
        share = F.when(F.col("lang") == name, min(1.0, SAMPLE / sizes[name])).otherwise(share)
    chosen = labelled.where(unit(F.lit(9), F.col("doc_id"), F.col("lang")) < share)
    fit = unit(F.lit(10), F.col("doc_id"), F.col("lang")) < 0.8
    return chosen.select(place.alias("_language"), fit.alias("_fit"), "text"), names


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages = batch.column("_language").to_numpy(zero_copy_only=False)
        texts = batch.column("text")
        for language in np.unique(languages):
            own = texts.take(pa.array(np.flatnonzero(languages == language))).to_pylist()
            for _, _, grams in _parts(own):
                keys, counts = np.unique(grams, return_counts=True)
                kind = pa.array(np.full(len(keys), language, np.int32))
                yield pa.RecordBatch.from_arrays([kind, pa.array(keys.view(np.int64)), pa.array(counts)], ["_language", "gram", "n"])


def train(labelled: DataFrame) -> Model | None:
    """The model of all languages in ``lang`` (columns ``doc_id, text, lang``); None if no row has a text and a language."""
    sample, names = _sampled(labelled)
    counted = sample.where("_fit").mapInArrow(_count, "_language int, gram bigint, n bigint")
    counted = counted.groupBy("_language", "gram").agg(F.sum("n").alias("n")).toArrow()  # of the bounded sample
    kinds, keys, counts = (counted.column(c).to_numpy() for c in ("_language", "gram", "n"))
    keys = keys.astype(np.int64).view(np.uint64)
    learnt = [i for i in range(len(names)) if (kinds == i).any()]
    if not learnt:
        return None
    order = np.argsort(keys, kind="stable")
    kinds, keys, counts = kinds[order], keys[order], counts[order]
    size = len(np.unique(keys & np.uint64(0xFFFF))) + 1
    models = [_Language(keys[kinds == i], counts[kinds == i]) for i in learnt]
    grams, weights = {}, {}
    for k in range(1, ORDER + 1):
        seen = np.unique(np.concatenate([m.levels[k][0] for m in models]))
        grams[k] = HashTable(seen, np.log(np.stack([m.probability(k, seen, size) for m in models], axis=1)))
        contexts = np.unique(np.concatenate([m.levels[k][3] for m in models]))
        weights[k] = HashTable(contexts, np.log(np.stack([m.weight(k, contexts) for m in models], axis=1)))
    noise = float(np.log(size))
    model = Model([names[i] for i in learnt], grams, weights, -noise, np.full(len(learnt), np.inf))
    model.limits = _limits(model, sample.where("NOT _fit"), noise)
    return model


def _limits(model: Model, held_back: DataFrame, noise: float) -> np.ndarray:
    """For each language a fourth of the way from what 99.9% of its texts that were not counted stay below, to noise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, letters = model.entropies(batch.column("text").to_pylist())
            best = found.argmin(axis=1)
            lowest = found[np.arange(len(best)), best]
            yield pa.RecordBatch.from_arrays([pa.array(best[letters].astype(np.int32)), pa.array(lowest[letters])], ["language", "entropy"])

    found = held_back.select("text").mapInArrow(run, "language int, entropy double")
    usual = {r["language"]: r["usual"] for r in found.groupBy("language").agg(F.percentile("entropy", 0.999).alias("usual")).collect()}
    limits = [usual.get(i, noise) for i in range(len(model.languages))]
    return np.array([u + max(0.0, noise - u) / 4 if i in usual else np.inf for i, u in enumerate(limits)])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred, score, cross_entropy, rejected``.

    A null text and one without a letter are ``und``, with score 0, and rejected; so is every text if nothing was
    learnt. A text whose cross-entropy lies above the limit of its language is rejected but named. Other columns are
    kept; columns with the added names are replaced.
    """
    added = ["lang_pred", "score", "cross_entropy", "rejected"]
    docs = docs.drop(*added)
    names = docs.columns
    if model is None:
        nothing = [F.lit(UNDETERMINED), F.lit(0.0), F.lit(0.0), F.lit(True)]
        return docs.withColumns(dict(zip(added, nothing, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, score, entropy, rejected = model.decide(batch.column("text").to_pylist())
            columns = [pa.array(found, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, *added])

    kinds = [T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType()]
    fields = [T.StructField(name, kind) for name, kind in zip(added, kinds, strict=True)]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def fold(doc_id: Column) -> Column:
    """The fold of a document; 1 is held out."""
    return F.crc32(doc_id.cast("string")) % 3


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold, then identify all; adds ``held_out`` too."""
    docs = docs.drop("held_out")
    model = train(docs.where(fold(F.col("doc_id")) != 1).select("doc_id", "text", "lang"))
    held_out = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    return identify(docs, model).withColumn("held_out", held_out)
