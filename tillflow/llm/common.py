"""Helpers of the training-data operators: intermediate tables, words, names of scratch columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import shared_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Rows that a Python task turns into numpy arrays at a time.
SLICE_ROWS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to a folder of its own below the shared folder and read it back.

    Later jobs start from the files, so a lost executor costs no recomputation and every reader sees the same rows.
    """
    path = f"{shared_dir(df.sparkSession)}/tillflow-llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the arguments only, so that reruns agree."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / F.lit(float(1 << 53))


def words(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z lower-cased. ``bytes.split`` splits at exactly the white space that WORD leaves out."""
    return text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() if text else []


class WordHashes(dict):
    """64-bit hash of each word, kept for words seen again; emptied when it gets large."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: the finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def with_text_columns(docs: DataFrame, added: dict[str, str], compute: Callable[[pa.Array], Iterator[list[pa.Array]]]) -> DataFrame:
    """``docs`` with the columns ``added`` (name and type), which ``compute`` makes of the column ``text`` batch by batch.

    ``compute`` gets the texts of a batch and yields the new columns for the first rows, then the next ones, until all are
    done. Columns that have an added name are replaced; others pass through under whatever names they have.
    """
    docs = docs.drop(*added)
    names, at = docs.columns, docs.columns.index("text")
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    inner = plain.select("*", *[F.lit(None).cast(kind).alias(f"a{i}") for i, kind in enumerate(added.values())])
    labels, schema = inner.columns, inner.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for columns in compute(batch.column(at)):
                own = batch.slice(done, len(columns[0]))
                done += len(columns[0])
                yield pa.RecordBatch.from_arrays([*own.columns, *columns], labels)

    return plain.mapInArrow(run, schema).toDF(*names, *added)
