"""Operator 6: what its law promises, and the plan against plain scheduling."""

import heapq
import random
import zlib

import pytest

from sparkmine.llm import sharding
from sparkmine.operators import skew
from tests.llm.frames import ODD_TEXTS, documents, sentence


def check(rows, result, shards):
    assert sorted(str(r.doc_id) for r in result) == sorted(str(i) for i, _ in rows)
    sizes = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in result) == sizes
    assert {(r.law, r.grown_shard) for r in result} <= {("bytes", None)}
    loads = [0] * shards
    for s in range(shards):
        mine = [r for r in result if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        loads[s] = sum(r["size"] for r in mine)
    assert sum(loads) == sum(r["size"] for r in result)
    return loads


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = [sentence(rng, rng.choice([1, 3, 20, 100, 400])) + str(i) for i in range(700)]
    texts += [texts[0]] * 30 + [texts[1]] * 5 + ODD_TEXTS + [None, "", None]
    return list(enumerate(texts))


def test_loads_and_groups(spark, rows):
    result = sharding.shard(documents(spark, rows), 7).collect()
    loads = check(rows, result, 7)
    text_of = dict(rows)
    homes = {}
    for r in result:
        homes.setdefault(text_of[r.doc_id], set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    groups = {}
    for _, t in rows:
        groups[t] = groups.get(t, 0) + len((t or "").encode()) + 1
    ideal = max(sum(loads) / 7, max(groups.values()))
    assert max(loads) <= ideal * 4 / 3


def test_copies_beyond_a_salt_stay_together(spark, monkeypatch):
    monkeypatch.setattr(skew, "SALT_ROWS", 20)
    monkeypatch.setattr(skew, "light", lambda rows, over: False)
    rows = [(i, "copied" if i % 3 else f"alone {i}") for i in range(200)] + [(i, None) for i in range(200, 260)]
    result = sharding.shard(documents(spark, rows), 5).collect()
    check(rows, result, 5)
    text_of = dict(rows)
    assert len({r.shard for r in result if text_of[r.doc_id] == "copied"}) == 1
    assert len({r.shard for r in result if text_of[r.doc_id] is None}) == 1


def test_near_equal_when_no_group_is_large(spark):
    rng = random.Random(12)
    rows = [(i, sentence(rng, rng.randrange(50, 300)) + str(i)) for i in range(800)]
    loads = check(rows, sharding.shard(documents(spark, rows), 16).collect(), 16)
    assert max(loads) - min(loads) <= 2_000  # some one per cent


def test_plan_equals_plain_scheduling():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 900) for _ in range(500)] + [10] * 300
    heap = [(0, i) for i in range(5)]
    for size in sorted(sizes, reverse=True):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
    histogram = [(s, sizes.count(s), s * sizes.count(s)) for s in set(sizes)]
    loads = [0] * 5
    for kind, (_, ends) in sharding.schedule(histogram, 5).items():
        for i, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
            loads[i] += kind * (b - a)
    assert sorted(loads) == sorted(load for load, _ in heap)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (None, None)]
    check(rows, sharding.shard(documents(spark, rows), 2).collect(), 2)


def test_empty_table(spark):
    assert sharding.shard(documents(spark, []), 4).collect() == []
    with pytest.raises(ValueError):
        sharding.shard(documents(spark, []), 0)
