"""SentencePiece ids of whole texts with the source bytes of every piece, and the way back.

Normalisation follows the model: the longest prefix that its compiled character map knows is replaced, anything else is
kept one character at a time, and every normalised byte remembers the source byte it comes from. Pieces are consecutive
runs of normalised bytes, so their ends carry over to the source. Merging symbols to pieces is the library's work.

A piece of the model that holds a white-space mark holds it in front only (checked when the model is loaded, as is that
the map is empty). Then no merge crosses from a word into the mark of the next, texts fall into words that are
encoded on their own, and a task encodes each different word once. Other models, and texts that hold the
mark itself, take the general way: the library encodes the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
_WORD = re.compile(" +[^ ]*")
KEPT_WORDS, KEPT_IDS = 150_000, 1_000_000
SLICE_ROWS = 200  # rows that a task holds as Python and numpy objects


class Normaliser:
    """The model's text normalisation with the source place of every byte."""

    def __init__(self, spec) -> None:
        self.dummy_prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.mark = (MARK if spec.escape_whitespaces else " ").encode()
        chars = spec.precompiled_charsmap
        cut = 4 + int.from_bytes(chars[:4], "little")
        self.units, self.texts = np.frombuffer(chars[4:cut], "<u4").tolist(), chars[cut:]

    def prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        """The replacement of the longest known prefix of ``data[at:]`` and the bytes it replaces."""
        best, length = -1, 0
        if self.units:
            node = self._child(0)
            for end in range(at, len(data)):
                node ^= data[end]
                if node >= len(self.units) or self.units[node] & 0x800000FF != data[end]:
                    break
                leaf = self.units[node] >> 8 & 1
                node ^= self._child(node)
                if leaf:
                    best, length = self.units[node] & 0x7FFFFFFF, end + 1 - at
        if length:
            return self.texts[best : self.texts.index(b"\0", best)], length
        lead = data[at]
        length = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at : at + length], length

    def _child(self, node: int) -> int:
        unit = self.units[node]
        return unit >> 10 << ((unit & 0x200) >> 6)

    def normalise(self, text: str) -> tuple[bytes, list[int]]:
        """Normalised bytes, and for each of them and for the end the source byte it starts from."""
        data, out, source = text.encode(), bytearray(), []
        at, after_space = 0, self.squeeze
        while self.squeeze and at < len(data):
            found, length = self.prefix(data, at)
            if found != b" ":
                break
            at += length
        if at == len(data):
            return b"", [at]
        if self.dummy_prefix:
            out += self.mark
            source += [at] * len(self.mark)
        while at < len(data):
            found, length = self.prefix(data, at)
            if after_space:
                found = found.lstrip(b" ")
            if found:
                shown = found.replace(b" ", self.mark)
                out += shown
                source += [at] * len(shown)
                after_space = self.squeeze and found.endswith(b" ")
            at += length
        while self.squeeze and out.endswith(self.mark):
            at = source[len(out) - len(self.mark)]
            del out[-len(self.mark) :], source[-len(self.mark) :]
        return bytes(out), [*source, at]


class Pieces:
    """A loaded model."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        self.library = SentencePieceProcessor(model_proto=model)
        self.normaliser = Normaliser(proto.normalizer_spec)
        n = self.library.get_piece_size()
        self.is_byte = np.array([self.library.is_byte(i) for i in range(n)])
        pieces = [p.piece for p in proto.pieces]
        self.bytes_of = np.array([1 if byte else len(p.encode()) for p, byte in zip(pieces, self.is_byte, strict=True)])
        self.lead = np.array([int(p[3:5], 16) if byte else 0 for p, byte in zip(pieces, self.is_byte, strict=True)])
        marks = np.array([p.count(MARK) for p in pieces])
        self.source_bytes_of = self.bytes_of - 2 * marks  # a mark stands for a space of one byte
        spec = proto.normalizer_spec
        plain = spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces
        user_defined = any(p.type == p.USER_DEFINED for p in proto.pieces)
        front_only = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.by_word = plain and not spec.precompiled_charsmap and not user_defined and front_only
        self.lone_mark = self.library.piece_to_id(MARK)
        self.places: dict[str, int] = {}  # of the words kept, in the two arrays that follow
        self.counts, self.flat = np.empty(0, np.int64), np.empty(0, np.int32)

    def _lengths(self, ids: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Bytes of each piece; a character that falls to several byte pieces counts for the last of them."""
        found = of[ids]
        left = 0
        for i in np.flatnonzero(self.lead[ids] >= 0x80):
            if not left:
                lead = self.lead[ids[i]]
                width = left = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            left -= 1
            found[i] = 0 if left else width
        return found

    def _look_up(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and their number for each word. Words begin with their white space.

        The words met first are kept for later calls, so frequent words are nearly always known.
        """
        new = list({w for own in split for w in own} - self.places.keys())
        ids = [own if w != " " else [self.lone_mark] for w, own in zip(new, self.library.encode([w[1:] for w in new], num_threads=1), strict=True)]
        counts = np.concatenate([self.counts, np.fromiter(map(len, ids), np.int64, len(ids))])
        flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32)])
        places = dict(zip(new, range(len(self.counts), len(counts)), strict=True))
        if len(counts) <= KEPT_WORDS and len(flat) <= KEPT_IDS:
            self.places.update(places)
            self.counts, self.flat, places = counts, flat, self.places
        else:
            places = self.places | places
        found = np.fromiter(map(places.__getitem__, chain.from_iterable(split)), np.int64)
        starts, own = (np.cumsum(counts) - counts)[found], counts[found]
        return flat[np.repeat(starts - (np.cumsum(own) - own), own) + np.arange(own.sum())], own

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.library.encode(text), np.int32)
        normal, source = self.normaliser.normalise(text)
        ends = np.cumsum(self._lengths(ids, self.bytes_of), dtype=np.int64)
        if len(ids) and ends[-1] != len(normal):
            raise ValueError("the pieces do not cover the normalised text")
        at = np.asarray(source)
        return ids, np.stack([at[np.concatenate([[0], ends])[:-1]], at[ends]])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each text its ids, and begins and ends of the pieces as two rows of source bytes."""
        split = [_WORD.findall(" " + t) if self.by_word and t and MARK not in t else [] for t in texts]
        flat, counts = self._look_up(split)
        lengths = self._lengths(flat, self.source_bytes_of)
        cuts = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *map(len, split)])]
        all_ids, spans = [], []
        for i, text in enumerate(texts):
            ids, own = flat[cuts[i] : cuts[i + 1]], lengths[cuts[i] : cuts[i + 1]]
            if split[i]:
                ends = np.cumsum(own) - 1  # the dummy prefix has no source
                span = np.stack([np.concatenate([[0], ends[:-1]]), ends])
            else:
                ids, span = self._whole(text)
            all_ids.append(ids)
            spans.append(span)
        return all_ids, spans


@lru_cache(maxsize=2)
def _load(model: bytes) -> Pieces:
    return Pieces(model)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays), pa.int32()))


def _decode(library, ids: pa.Array) -> pa.Array:
    """The library's text of each list of ids; empty for null and for no ids."""
    found = [library.decode(own) if own else "" for own in ids.to_pylist()]
    return pa.array(found, pa.string())


def encode(docs: DataFrame, model: bytes, decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids``, ``begins`` and ``ends``: the pieces of ``text`` and the source bytes of each.

    ``model`` is the content of a model file: tasks need no file of their own. No begin or end ids, no sampling. Null
    and empty texts have no pieces. With ``decoded`` the ids are also decoded, in the same pass, into a column of that name.
    All other columns are kept; columns named like the new ones are replaced.
    """
    docs = docs.drop("ids", "begins", "ends", *["decoded"] * decoded)
    names = [*docs.columns, "ids", "begins", "ends", *["decoded"] * decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _load(model)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                ids, spans = pieces.encode([t or "" for t in part.column("text").to_pylist()])
                added = [_lists(ids), _lists([s[0] for s in spans]), _lists([s[1] for s in spans])]
                if decoded:
                    added.append(_decode(pieces.library, added[0]))
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names)

    lists = T.ArrayType(T.IntegerType())
    added = [T.StructField(n, T.StringType() if n == "decoded" else lists) for n in names[len(docs.columns) :]]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``encoded`` with ``decoded``, the text that the library makes of ``ids``; null or no ids give an empty text."""
    encoded = encoded.drop("decoded")
    names = [*encoded.columns, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _load(model).library
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, _decode(library, part.column("ids"))], names)

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
