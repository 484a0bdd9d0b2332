"""Frames and plain references for the tests of the training-data operators."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def documents(spark, *texts, source="s"):
    return frame(spark, [(i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)])


def shingle_set(text):
    words = [w.translate(LOWER) for w in WORD.findall(text or "")]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def by_id(found, key="doc_id"):
    return {row[key]: row for row in found.collect()}


def roots(nodes, links):
    """Smallest node of each node's component."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
