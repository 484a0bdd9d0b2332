from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from helpers import frame

from tillflow.llm import lang_id

SYLLABLES = {"en": "the ing and of ation er th".split(), "de": "der sch ung ein ich über zu".split(), "fr": "les tion eau è que oi".split()}


def corpus(n=600, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = draw.choice(list(SYLLABLES))
        words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(draw.randint(10, 80))]
        rows.append((i, " ".join(words), lang, "s", 0))
    return rows


@pytest.fixture(scope="module")
def found(spark):
    rows = [*corpus(), (9000, None, None, None, None), (9001, " 12 !", "en", "s", 0), (9002, "", None, "s", 0), (9003, " ", "de", "s", 0), (9004, "😀" * 5, "fr", "s", 0), (9005, "zq xj kvw pqzx vbkq " * 40, None, "s", 0), (9006, "THE ING " * 200_000, None, "s", 0), (None, "les eau que", "fr", "s", 0)]
    docs = frame(spark, rows).withColumnRenamed("n_chars", "score")
    return rows, {r["doc_id"]: r for r in lang_id.learn_and_identify(docs).collect()}


def test_held_out_documents_are_named(found):
    rows, by_id = found
    held = [r for r in rows[:600] if by_id[r[0]]["held_out"]]
    assert {r[0] for r in held} == {r[0] for r in rows[:600] if zlib.crc32(str(r[0]).encode()) % 3 == 1}
    assert sum(by_id[r[0]]["lang_pred"] == r[2] for r in held) >= 0.98 * len(held)
    assert not any(by_id[r[0]]["rejected"] for r in rows[:600])
    assert all(0 <= r["score"] <= 1 for r in by_id.values())


def test_no_letter_is_undetermined_and_noise_is_rejected(found):
    by_id = found[1]
    for i in range(9000, 9005):
        assert by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 and by_id[i]["rejected"]
    assert by_id[9005]["rejected"] and by_id[9005]["lang_pred"] in SYLLABLES
    assert by_id[9006]["lang_pred"] == "en"
    assert by_id[None]["lang_pred"] == "fr" and by_id[None]["held_out"] is False


def test_probabilities_sum_to_one():
    draw = np.random.default_rng(1)
    symbols = draw.integers(97, 102, 3000).astype(np.uint16)
    keys, counts = np.unique(lang_id._grams(symbols), return_counts=True)
    own = lang_id._Language(keys, counts)
    for context in [keys[0] >> np.uint64(16), np.uint64(0x61_0061_0078)]:
        every = (context << np.uint64(16)) | np.arange(97, 102, dtype=np.uint64)
        total = own.probability(4, every, 6).sum()
        unseen = own.probability(4, (context << np.uint64(16)) | np.array([122], np.uint64), 6).sum()
        assert total + unseen == pytest.approx(1, abs=1e-9)


def test_tables_give_what_the_language_gives():
    draw = np.random.default_rng(2)
    keys, counts = np.unique(lang_id._grams(draw.integers(97, 105, 2000).astype(np.uint16)), return_counts=True)
    own = lang_id._Language(keys, counts)
    grams = {k: lang_id.HashTable(own.levels[k][0], np.log(own.probability(k, own.levels[k][0], 9))[:, None]) for k in range(1, 5)}
    weights = {k: lang_id.HashTable(own.levels[k][3], np.log(own.weight(k, own.levels[k][3]))[:, None]) for k in range(1, 5)}
    model = lang_id.Model(["x"], grams, weights, -float(np.log(9)), np.array([np.inf]))
    asked = lang_id._grams(draw.integers(97, 108, 500).astype(np.uint16))
    assert model._log(4, asked)[:, 0] == pytest.approx(np.log(own.probability(4, asked, 9)), rel=1e-4)


def test_long_texts_are_scored_in_parts(monkeypatch):
    keys, counts = np.unique(lang_id._grams(lang_id._text_symbols("the cat and the dog " * 50)), return_counts=True)
    own = lang_id._Language(keys, counts)
    table = {k: lang_id.HashTable(own.levels[k][0], np.log(own.probability(k, own.levels[k][0], 30))[:, None]) for k in range(1, 5)}
    weight = {k: lang_id.HashTable(own.levels[k][3], np.log(own.weight(k, own.levels[k][3]))[:, None]) for k in range(1, 5)}
    model = lang_id.Model(["x"], table, weight, -3.4, np.array([np.inf]))
    whole = model.entropies(["the cat " * 300, "x", ""])[0]
    monkeypatch.setattr(lang_id, "PART", 500)
    assert model.entropies(["the cat " * 300, "x", ""])[0] == pytest.approx(whole, abs=0.05)


def test_nothing_learnt_and_no_rows(spark):
    docs = frame(spark, [(1, "abc", None, "s", 0)])
    assert [(r["lang_pred"], r["rejected"]) for r in lang_id.learn_and_identify(docs).collect()] == [("und", True)]
    assert lang_id.learn_and_identify(docs.limit(0)).collect() == []


def test_a_text_in_parts_scores_like_the_whole(spark, monkeypatch):
    rows = [(i, text, lang) for i, (text, lang) in enumerate([("the quick brown fox  jumps", "en"), ("der schnelle braune Fuchs", "de")] * 30)]
    model = lang_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    texts = ["the  quick -- brown fox, jumps over the lazy dog; der   Fuchs 123 ist braun", "   ", "a", "", None, " x  y "]
    whole = model.entropies(texts)
    for size in (1, 2, 7, 30):
        monkeypatch.setattr(lang_id, "PART", size)
        for seen, expected in zip(model.entropies(texts), whole, strict=True):
            assert np.allclose(seen.astype(float), expected.astype(float), atol=1e-6)
