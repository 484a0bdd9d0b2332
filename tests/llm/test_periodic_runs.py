from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import WORD, by_id, documents, frame

from tillflow.llm import periodic_runs
from tillflow.llm.queries import registry


def brute(words, least=6, periods=4):
    """Every run by definition: maximal stretches for each period, of which it is the smallest."""
    found = set()
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i:
                run = words[i : j + q]
                smaller = any(all(run[k] == run[k + d] for k in range(len(run) - d)) for d in range(1, q))
                if not smaller and len(run) >= max(least, periods * q):
                    found.add((i, len(run), q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    shown = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = best[1] * 1000 // best[2] if runs else None
    return (len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (shown, left)))


def texts():
    draw = random.Random(5)
    some = ["", None, "   ", "a", "a a a a a", "a a a a a a", "a\x0b" * 9 + "  b", "A a " * 6, "x y " * 3 + "x", "x y " * 4]
    for _ in range(150):
        letters = draw.choice(["ab", "abc", "abcdefgh"])
        words = [draw.choice(letters) for _ in range(draw.randrange(1, 90))]
        if draw.random() < 0.6:
            part = [draw.choice(letters + "xyz") for _ in range(draw.randrange(1, 20))]
            words += part * draw.randrange(2, 9) + part[: draw.randrange(len(part))] + words[:7]
        some.append(" ".join(words))
    fib = "a", "a b"
    for _ in range(9):
        fib = fib[1], f"{fib[1]} {fib[0]}"
    return [*some, fib[1], "z " * 3000, " ".join(["p q r", "p q s"] * 60)]


def test_runs_are_those_of_the_definition():
    for text in texts():
        words = (text or "").encode().split()
        assert [tuple(r) for r in periodic_runs.runs_of([words])[0].tolist()] == brute(words)


def test_many_texts_at_once_and_one_by_one_agree(monkeypatch):
    split = [(t or "").encode().split() for t in texts()]
    together = periodic_runs.runs_of(split)
    assert all(np.array_equal(a, periodic_runs.runs_of([w])[0]) for a, w in zip(together, split, strict=True))
    monkeypatch.setattr(periodic_runs, "SLICE_BYTES", 40)
    assert [w for part in periodic_runs.slices(texts()) for w in part] == split


def test_three_periods():
    assert periodic_runs.find_runs(np.array([0, 1, 2] * 3 + [9]), np.array([10]), least=2, periods=3).tolist() == [[0, 9, 3]]


def test_query(spark, tmp_path):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts())] + [(None, "a " * 8, None, None, None), (3, "b " * 8, "en", "s", 2)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = registry()["op11_periodic_runs"](spark, str(tmp_path))
    seen = sorted(map(tuple, found.collect()), key=str)
    assert seen == sorted(((i, *expected(i, t)) for i, t, *_ in rows), key=str)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in seen)


def test_collapse_keeps_other_columns(spark):
    docs = documents(spark, "w " * 7 + "end", None).selectExpr("*", "1 AS runs", "n_chars AS `a.b`")
    found = by_id(periodic_runs.collapse_runs(docs))
    assert found[0]["collapsed"] == "w end" and found[0]["runs"][0].asDict() == {"start": 0, "length": 7, "period": 1}
    assert found[1]["collapsed"] == "" and found[1]["runs"] == [] and found[1]["lang"] == "en"


@pytest.mark.parametrize("op", [periodic_runs.collapse_runs, periodic_runs.plant])
def test_empty_table(spark, op):
    assert op(documents(spark)).collect() == []


def test_a_very_long_text(spark):
    word_count = 400_000
    text = " ".join(str(i) for i in range(word_count // 2)) + " one two" * (word_count // 4)
    row = periodic_runs.collapse_runs(documents(spark, text)).first()
    assert [tuple(r) for r in row["runs"]] == [(word_count // 2, word_count // 2, 2)]
    assert row["collapsed"].endswith("199999 one two")
