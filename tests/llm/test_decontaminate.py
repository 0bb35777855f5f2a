"""Operator 2 against brute force."""

import hashlib
import random
import re

import pytest

from sparkmine.llm import decontaminate
from sparkmine.operators import skew
from tests.llm.frames import ODD_TEXTS, documents, sentence


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, window=13):
    spans = {}
    for item_id, text in items:
        if item_id is None:
            continue
        words = words_of(text)
        m = min(window, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            spans.setdefault(tuple(words[i : i + m]), set()).add(str(item_id))
    lengths = {len(s) for s in spans}
    out = []
    for doc_id, text in rows:
        words, hit, named = words_of(text), set(), set()
        for m in lengths:
            for i in range(len(words) - m + 1):
                met = spans.get(tuple(words[i : i + m]))
                if met:
                    hit |= set(range(i, i + m))
                    named |= met
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        bad = len(hit) > 0 and 20 * len(hit) >= len(words)
        out.append((doc_id, len(words), len(hit), len(named), digest, bad))
    return sorted(out, key=str)


def found(frame):
    assert frame.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    few = ["x", "y"]
    items = [(i, sentence(rng, n, few if n < 8 else [f"v{j}" for j in range(30)])) for i, n in enumerate([1, 2, 5, 12, 13, 14, 15, 40, 60])]
    items += [(20, None), (21, ""), (22, "!!"), (None, "v1 v2 v3"), (7, items[7][1]), (23, items[8][1])]
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    for i in range(60):
        text = sentence(rng, rng.choice([0, 3, 13, 50, 300]), [f"v{j}" for j in range(30)])
        for _ in range(rng.choice([0, 1, 2])):
            _, piece = rng.choice(items[3:9])
            cut = piece.split(" ")
            a = rng.randrange(len(cut))
            text += " " + " ".join(cut[a : a + rng.choice([12, 13, 14, 50])]).upper() + ", " + sentence(rng, 20)
        rows.append((100 + i, text))
    rows += [(100, rows[-1][1]), (None, rows[-2][1]), (None, None), (300, sentence(rng, 400, few))]
    return rows, items


def bench(spark, items):
    frame = spark.createDataFrame(items, "item_id long, text string")
    return frame.selectExpr("*", "'x' as words", "'x' as print", "'x' as marks")


def test_equals_brute_force(spark, tables):
    rows, items = tables
    assert found(decontaminate.contamination(documents(spark, rows), bench(spark, items))) == brute(rows, items)


def test_without_broadcast(spark, tables, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    rows, items = tables
    assert found(decontaminate.contamination(documents(spark, rows), bench(spark, items))) == brute(rows, items)


def test_a_passage_of_many_documents_without_broadcast(spark, tables, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(decontaminate, "ARRAY_ROWS", 20)
    monkeypatch.setattr(skew, "light", lambda rows, over: False)
    rows, items = tables
    rng = random.Random(4)
    rows = rows + [(1000 + i, f"{sentence(rng, 9)} {items[8][1]} {sentence(rng, 9)}") for i in range(150)]
    assert found(decontaminate.contamination(documents(spark, rows), bench(spark, items))) == brute(rows, items)


def test_other_window(spark, tables):
    rows, items = tables
    got = decontaminate.contamination(documents(spark, rows), bench(spark, items), window=6, k=3)
    assert found(got) == brute(rows, items, 6)


def test_empty_tables(spark, tables):
    rows, items = tables
    assert found(decontaminate.contamination(documents(spark, []), bench(spark, items))) == []
    assert found(decontaminate.contamination(documents(spark, rows[:20]), bench(spark, []))) == brute(rows[:20], [])
