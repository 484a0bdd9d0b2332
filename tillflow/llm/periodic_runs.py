"""Runs in texts: maximal stretches of words that repeat with a period, found through a dictionary of basic factors.

For each power of two L the factors of L words that occur more than once get a name, from the names of their halves. Two
successive occurrences of a factor that lie in a window of 2 L words, so at most L apart, propose their distance
as a period, and neighbouring occurrences that propose the same distance form an arithmetic progression. A progression
over the places i to e says that word j equals word j + p for j from i to e + L - 1, and no neighbour of it does, so it is
extended to the stretch from i to e + L - 1 + p. A run of at least three periods q shows at the power of two from q to below
2 q, where its factors recur at q and not sooner; what several lengths find is kept once.

Many texts are handled as one sequence. A place whose factor does not recur in its text is left out of the longer factors,
so texts without repeats end after two or three rounds, and memory is linear in the words of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import with_text_columns

#: Bytes of text that a task turns into one sequence; a longer text is a slice of its own.
SLICE_BYTES = 2_000_000
LEAST_WORDS, LEAST_PERIODS = 6, 4


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of equal keys together, in rising order, and whether the next one has the same key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    return order, ordered[1:] == ordered[:-1]


def find_runs(words: np.ndarray, ends: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """All runs of at least ``least`` words and ``periods`` (three or more) smallest periods, as rows ``start, length, period``.

    ``words`` holds the numbers of the words of several texts on end, ``ends`` the end of each text. Starts count from the
    first text on; rows are in the order of start and period.
    """
    if not len(words):
        return np.zeros((0, 3), np.int64)
    text_of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    end_of = ends[text_of]
    # A word of another text is another word.
    names = np.unique(text_of * (int(words.max()) + 1) + words, return_inverse=True)[1]
    longest = int(np.diff(ends, prepend=0).max())
    places, size, found = np.arange(len(words)), 1, []
    while True:
        order, same = _groups(names)
        distance = np.zeros(len(places), np.int64)
        distance[order[:-1]] = np.where(same, places[order[1:]] - places[order[:-1]], 0)
        found.append(_stretches(places, distance, size))
        if size * periods >= longest:
            break
        # Factors of twice the length, where both halves occur more than once.
        recurs = np.zeros(len(places), bool)
        recurs[order[1:]] |= same
        recurs[order[:-1]] |= same
        places, names = places[recurs], names[recurs]
        half = np.searchsorted(places, places + size)
        both = (half < len(places)) & (places + 2 * size <= end_of[places])
        both[both] = places[half[both]] == places[both] + size
        if not both.any():
            break
        pairs = names[both] * (int(names.max()) + 1) + names[half[both]]
        places, names = places[both], np.unique(pairs, return_inverse=True)[1]
        size *= 2
    runs = np.unique(np.concatenate(found), axis=0)
    runs = runs[(runs[:, 1] >= least) & (runs[:, 1] >= periods * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _stretches(places: np.ndarray, distance: np.ndarray, size: int) -> np.ndarray:
    """Progressions of neighbouring places that propose the same period, extended: ``start, length, period``."""
    near = (distance > 0) & (distance <= size)
    at, period = places[near], distance[near]
    if not len(at):
        return np.zeros((0, 3), np.int64)
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1] + 1) | (period[1:] != period[:-1])
    begin = np.flatnonzero(first)
    last = np.append(begin[1:], len(at)) - 1
    return np.stack([at[begin], at[last] - at[begin] + size + period[begin], period[begin]], axis=1)


def kept(length: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``length`` words stay when each run is reduced to its first period."""
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def slices(texts: Iterator[str | None]) -> Iterator[list[list[bytes]]]:
    """The words of the texts, some SLICE_BYTES of text at a time. ``bytes.split`` splits at ASCII white space only."""
    ready, size = [], 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        ready.append(data.split())
        size += len(data)
        if size >= SLICE_BYTES:
            yield ready
            ready, size = [], 0
    if ready:
        yield ready


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, given as lists of words; starts count within the text."""
    numbers: dict[bytes, int] = {}
    words = np.array([numbers.setdefault(word, len(numbers)) for text in texts for word in text], np.int64)
    ends = np.cumsum([len(text) for text in texts])
    runs = find_runs(words, ends)
    starts = np.concatenate([[0], ends[:-1]])
    edges = np.searchsorted(runs[:, 0], np.append(starts, len(words)))
    return [runs[a:b] - [start, 0, 0] for a, b, start in zip(edges[:-1], edges[1:], starts, strict=True)]


RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``runs``, all runs of the words of ``text`` by start and period, and ``collapsed``.

    ``collapsed`` joins the words that are left by one blank when every run is reduced to its first period. A null or
    empty text, and one without a word, has no runs and collapses to an empty text. Repeated rows get their results each,
    an empty table an empty result; a null in another column stays one. Columns named ``runs`` and ``collapsed`` are replaced.
    A very long text is handled whole, in memory linear in its words.
    """

    def compute(column: pa.Array) -> Iterator[list[pa.Array]]:
        for texts in slices(value.as_py() for value in column):
            runs = runs_of(texts)
            plain = []
            for words, own in zip(texts, runs, strict=True):
                left = kept(len(words), own)
                plain.append(b" ".join(word for word, stays in zip(words, left.tolist(), strict=True) if stays))
            every, offsets = np.concatenate(runs), np.cumsum([0, *[len(r) for r in runs]])
            structs = pa.StructArray.from_arrays([pa.array(every[:, i]) for i in range(3)], ["start", "length", "period"])
            collapsed = pa.array([p.decode("utf-8", "surrogatepass") for p in plain], pa.string())
            yield [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs), collapsed]

    return with_text_columns(docs, {"runs": RUN, "collapsed": "string"}, compute)


def plant(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the repeats that the checked query plants in a tenth of the documents.

    With h the checksum of the decimal id, a tenth (h % 10 = 0) of the documents repeat from word a on with period p. The
    words are then joined by one blank; other texts stay as they are. A null id is not among the tenth.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column("turn").to_pylist()
            changed = [text if turn is None else planted(text or "", turn) for text, turn in zip(batch.column("text").to_pylist(), turns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(changed, pa.string())], ["doc_id", "text"])

    mark = F.crc32(F.col("doc_id").cast("string"))
    marked = docs.select("doc_id", "text", F.when(mark % 10 == 0, F.floor(mark / 10)).alias("turn"))
    return marked.mapInArrow(run, docs.select("doc_id", "text").schema)


def planted(text: str, turn: int) -> str:
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    if not n:
        return text
    at = turn % n
    period = 1 + (n - at) // (3 + turn % 8)
    return b" ".join(words[:at] + [words[at + i % period] for i in range(n - at)]).decode("utf-8", "surrogatepass")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the checked query from ``doc_id, runs, collapsed``."""
    shown = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(shown, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(""))
    # Lengths and periods stay far below 2 ** 31, so the products are exact.
    best = F.aggregate(
        "runs",
        F.try_element_at("runs", F.lit(1)),
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top),
    )
    found = docs.withColumn("_best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("1000 * _best.length DIV _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
