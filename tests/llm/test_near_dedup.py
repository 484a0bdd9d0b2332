from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import by_id, documents, frame, roots, shingle_set

from tillflow.llm import near_dedup
from tillflow.llm.common import WordHashes


def expected(texts):
    sets = dict(enumerate(map(shingle_set, texts)))
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, roots(sets, links)


def corpus(seed):
    """Texts with exact copies, near copies around the limit, a passage that most share, short and empty ones."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randint(2, 6)))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(40):
        base = [word() for _ in range(draw.randint(20, 120))]
        base = base + passage if draw.random() < 0.6 else base
        texts.append(" ".join(base))
        for _ in range(draw.choice([0, 0, 1, 3])):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = word()
            texts.append(" ".join(copy).upper() if draw.random() < 0.2 else "\n".join(copy))
    return [*texts, "", None, "one", "ONE ", "two words", " \t", texts[0], "a b c d e", "a b c d"]


@pytest.mark.parametrize("seed", [1])
def test_matches_comparing_all_pairs(spark, seed):
    texts = corpus(seed)
    sizes, root = expected(texts)
    found = by_id(near_dedup.near_duplicates(documents(spark, *texts)))
    assert {i: r["n_shingles"] for i, r in found.items()} == sizes
    assert {i: r["component_id"] for i, r in found.items()} == root
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.values())


def test_pairs_at_the_threshold_among_many_texts_that_are_close(spark):
    """Hundreds of texts whose shares of a common text are just too small; each has one partner that is just near enough."""
    draw = random.Random(11)
    base = [f"w{i}" for i in range(160)]

    def changed(words, name, at):
        return [f"{name}{i}" if i in at else w for i, w in enumerate(words)]

    texts = []
    for i in range(300):
        one = changed(base, f"a{i}x", set(range(draw.randrange(100), 160)[:26]))
        texts += [" ".join(one), " ".join(changed(one, f"b{i}x", {draw.randrange(20, 60), draw.randrange(60, 70), draw.randrange(80, 90)}))]
    sizes, root = expected(texts)
    found = by_id(near_dedup.near_duplicates(documents(spark, *texts)))
    assert {i: r["component_id"] for i, r in found.items()} == root
    assert 200 <= sum(root[i] != i for i in root) <= 320


def test_many_rows_without_id(spark):
    """Rows without id meet the texts of their classes by a hash of the text, not all of them."""
    rows = [(None, f"text number {i} has its own words {i} {i + 1}") for i in range(300)] + [(None, f"text number {i} has its own words {i} {i + 1}") for i in range(100)]
    found = near_dedup.near_duplicates(frame(spark, rows, "doc_id bigint, text string")).collect()
    assert len(found) == 400 and not any(r["kept"] for r in found)
    assert near_dedup.deduplicate(frame(spark, rows, "doc_id bigint, text string")).count() == 300


def test_nulls_repeats_and_clashing_columns(spark):
    long = "w " * 50_000 + "end"
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "x"), (2, long, None), (None, None, None), (3, "", "y")]
    docs = frame(spark, rows, "doc_id bigint, text string, node string").withColumnRenamed("node", "component_id")
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == 6
    assert sorted((r["component_id"], r["kept"]) for r in found if r["n_shingles"] == 2 and r["doc_id"] != 2) == [(1, False), (1, True), (1, True)]
    assert near_dedup.near_duplicates(docs.limit(0)).collect() == []
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "None"]


def test_one_row_of_a_group_without_ids_stays(spark):
    docs = frame(spark, [(None, "a b c d e f"), (None, "a b c d e f")], "doc_id bigint, text string")
    assert near_dedup.deduplicate(docs).count() == 1


def test_signatures_within_the_distance_share_a_key():
    draw = np.random.default_rng(7)
    one = draw.integers(0, 1 << near_dedup.BITS, (200, near_dedup.PLACES), dtype=np.uint64)
    other = one.copy()
    for row in other:
        changed = draw.choice(near_dedup.PLACES, 15, replace=False)
        row[changed] ^= np.uint64(1)
    for a, b in zip(near_dedup._keys(one), near_dedup._keys(other), strict=True):
        shared = {int(k) & 15 for k in set(a.tolist()) & set(b.tolist())}
        assert len(shared) >= 2


def test_shingles_are_distinct_and_ignore_case():
    hashes = WordHashes()
    assert len(near_dedup.shingles("a b c d e a b c d e", hashes)) == 5
    assert (near_dedup.shingles("A b C d E", hashes) == near_dedup.shingles("a b c\td e", hashes)).all()
    assert len(near_dedup.shingles("É b", hashes)) == 1 and not len(near_dedup.shingles(None, hashes))


def test_sketches_never_differ_more_than_the_sets():
    draw = np.random.default_rng(9)
    pool = draw.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for size in (3, 150, 900, 4000):
        one, other = (np.unique(draw.choice(pool, size)) for _ in range(2))
        a, b = (near_dedup._signature(x)[near_dedup.CHUNKS :].view(np.uint64) for x in (one, other))
        turned = sum(int(x).bit_count() for x in a ^ b)
        apart = len(np.setxor1d(one, other))
        assert turned <= apart and (turned - apart) % 2 == 0
