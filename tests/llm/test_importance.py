from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from helpers import LOWER, by_id, documents, frame

from tillflow.llm import importance
from tillflow.llm.queries import registry

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    words = TERM.findall((text or "").translate(LOWER))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bucket(gram):
    return zlib.crc32(gram.encode()) % 10_000


def brute(docs, target):
    """``[doc_id, n_features, weight, score, rank]`` of all rows, by the words of the contract."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, grams(text)))
    for text in target:
        t.update(map(bucket, grams(text)))
    all_s, all_t = sum(s.values()), sum(t.values())
    found = []
    for doc_id, text in docs:
        own = grams(text)
        gain = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10000) / ((s[b] + 1.0) * (all_t + 10000)))) for b in map(bucket, own)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, len(own), weight, score, len(TERM.findall(text or ""))])
    due = [r for r in found if r[4] >= 20]
    order = sorted(range(len(found)), key=lambda i: (-found[i][3], -math.inf if found[i][0] is None else found[i][0]))
    order = [i for i in order if found[i][4] >= 20][: 25 * len(due) // 100]
    for r in found:
        r[4] = None
    for rank, i in enumerate(order, 1):
        found[i][4] = rank
    return sorted(map(tuple, found), key=str)


def corpus():
    draw = random.Random(3)
    vocabulary = ["the", "of", "Ünïcode", "X1", "日本", "don't", "é", "a", "longer", "word", "Zz"]
    rows = [(i, "".join(draw.choice(vocabulary) + draw.choice([" ", " ", ", ", "\n", "--", "\t"]) for _ in range(draw.randrange(60)))) for i in range(300)]
    return [*rows, (900, None), (901, ""), (902, "…, ---"), (903, "w" * 70_000 + " é" * 30), (904, " ".join(["x" * 255, "y" * 256, "z" * 257, "q" * 513] * 6))]


def test_checksums_are_those_of_the_library():
    draw = np.random.default_rng(1)
    data = draw.integers(0, 256, 40_000, dtype=np.uint8)
    for lengths in ([1, 2, 3, 4, 5], [255, 256, 257, 511, 512, 513, 1024, 9000], draw.integers(1, 900, 60).tolist()):
        ends = np.cumsum(lengths)
        starts = ends - lengths
        seen = importance.span_checksums(data, starts, ends).tolist()
        assert seen == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


def test_spans_may_be_cut_anywhere(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 9000, dtype=np.uint8)
    starts, ends = np.array([0, 10, 10, 700, 3]), np.array([9000, 11, 800, 701, 600])
    whole = importance.span_checksums(data, starts, ends)
    monkeypatch.setattr(importance, "GROUP_BYTES", 300)
    assert importance.span_checksums(data, starts, ends).tolist() == whole.tolist()
    assert whole.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


def test_query(spark, tmp_path):
    rows, target = corpus(), ["the of the of a longer word", "x1 Zz zz", None, ""]
    frame(spark, [(i, t, None, "s", 1) for i, t in rows]).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, [(i, t) for i, t in enumerate(target)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = registry()["op13_importance_resampling"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, target)


def test_repeats_and_missing_ids(spark):
    long = "one two three four five six seven eight nine ten " * 3
    rows = [(1, long)] * 6 + [(None, long), (None, long), (2, long + "x"), (2, None), (1, "short")]
    docs = frame(spark, rows, "doc_id bigint, text string")
    found = importance.rank_documents(docs, docs.limit(0), share_percent=50).select("doc_id", "n_features", "weight", "score", "rank")
    seen = sorted(map(tuple, found.collect()), key=str)
    assert len(seen) == len(rows) and sorted(r[4] for r in seen if r[4]) == [1, 2, 3, 4]


def test_resample_returns_whole_rows(spark):
    rows = [(i, t, "en", "s", i) for i, t in corpus()] + [(7000, "w " * 40, "en", "s", 5)] * 8
    docs = frame(spark, rows).selectExpr("*", "1 AS score", "2 AS mark", "'x' AS rank")
    drawn = importance.resample(docs, docs.select("text").limit(3), share_percent=40)
    ranked = importance.rank_documents(docs, docs.select("text").limit(3), share_percent=40).where("rank IS NOT NULL")
    assert drawn.columns == docs.columns
    assert sorted(r["doc_id"] for r in drawn.collect()) == sorted(r["doc_id"] for r in ranked.collect())


def test_weights_favour_the_target(spark):
    docs = documents(spark, *["alpha beta gamma " * 10 if i % 2 else "delta epsilon zeta " * 10 for i in range(40)])
    target = documents(spark, "alpha beta gamma " * 50)
    found = by_id(importance.rank_documents(docs, target))
    assert min(r["weight"] for i, r in found.items() if i % 2) > max(r["weight"] for i, r in found.items() if not i % 2)


def test_empty_tables(spark):
    none = documents(spark)
    assert importance.rank_documents(none, none).collect() == [] and importance.resample(none, none).collect() == []
    assert importance.rank_documents(documents(spark, "a b"), none).first()["rank"] is None


def test_texts_do_not_run_into_each_other(spark):
    found = by_id(importance.rank_documents(documents(spark, "a", "b c", "", "d"), documents(spark)))
    assert [found[i]["n_features"] for i in range(4)] == [1, 3, 0, 1]
