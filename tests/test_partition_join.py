"""Candidates among large sets by the partitions that they have in common."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.operators import jaccard_join, partition_join, storage
from sparkmine.operators.partition_join import differences, packed, pairs_in, partitions, schemes, tokens, unpacked
from tests import brute

K = 5
FLAT = np.full(1 << partition_join.RARE_BITS, 3, np.uint8)


def near_sets(rng, sizes, threshold):
    """Sets of these sizes, each with one that is only just similar, larger, smaller or of its size."""
    out = []
    for at, n in enumerate(sizes):
        own = rng.choice(1 << 32, n, replace=False)
        if at % 3 == 0:
            other = rng.permutation(own)[: int(np.ceil(threshold * n))]
        elif at % 3 == 1:
            other = np.append(own, rng.choice(1 << 32, int(n / threshold) - n))
        else:
            shared = int(np.ceil(2 * n * threshold / (1 + threshold)))
            other = np.append(rng.permutation(own)[:shared], rng.choice(1 << 32, n - shared))
        out += [np.unique(own), np.unique(other)]
    return out


@pytest.mark.parametrize("threshold", [0.75, 0.8, 0.95, 1.0])
def test_similar_sets_have_a_token_in_common(threshold):
    rng = np.random.default_rng(2)
    sets = near_sets(rng, [545, 600, 816, 817, 900, 1023, 1024, 1025, 1279, 1280, 1300, 3000, 4095, 4097] * 3, threshold)
    sizes = np.array([len(s) for s in sets])
    held = [set() for _ in sets]
    rare = rng.integers(0, 8, 1 << partition_join.RARE_BITS).astype(np.uint8)
    weak = set()
    for owner, key, few in tokens(np.concatenate(sets), sizes, threshold, rare):
        weak |= {*few.tolist()}
        for o, x in zip(owner.tolist(), key.tolist(), strict=True):
            held[o].add(x)
    assert not weak
    similar = 0
    for i in range(0, len(sets), 2):
        a, b = set(sets[i].tolist()), set(sets[i + 1].tolist())
        if len(a & b) / len(a | b) >= threshold:
            similar += 1
            assert held[i] & held[i + 1]
    assert similar >= len(sets) // 4


def test_tokens_are_as_many_as_differences_and_one():
    sizes = np.array([545, 1000, 1024, 1200, 1279, 1281, 100_000])
    assert differences(np.array([1000]), 0.8, 1250).tolist() == [250]
    asked = [(some.tolist(), scheme.tolist(), need.tolist()) for some, scheme, need in schemes(sizes, 0.8)]
    assert asked[0] == ([*range(7)], [9, 9, 10, 10, 10, 10, 16], [137, 251, 257, 301, 320, 321, 25001])
    assert asked[1][:2] == ([0, 2, 3], [8, 9, 9])  # those of which the smaller may be of the class below
    assert (partitions(np.arange(9, 20), 0.8) > (2 << np.arange(9, 20)) // 4).all()


def test_packed_tokens_come_back():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << partition_join.KEY_BITS, 5000).astype(np.uint64)
    keys[:9] = keys[9]
    sets = rng.integers(0, 700, 5000)
    got = []
    for bucket, count, shift, start, data in packed(keys, sets, 700, 16):
        key, own = unpacked(count, shift, start, data)
        assert (key * np.uint64(16) >> np.uint64(partition_join.KEY_BITS) == bucket).all() and len(data) <= 6 * count + 6
        got += zip(key.tolist(), own.tolist(), strict=True)
    assert sorted(got) == sorted(zip(keys.tolist(), sets.tolist(), strict=True))


@pytest.mark.parametrize("short", [1, 3, 16])
def test_each_pair_of_a_list_comes_once(monkeypatch, short):
    """Lists by rows or by products of matrices, in tiles, cut or not."""
    monkeypatch.setattr(partition_join, "SHORT_LIST", short)
    monkeypatch.setattr(partition_join, "TILE", 4)
    monkeypatch.setattr(partition_join, "LIST_SETS", 3)
    monkeypatch.setattr(partition_join, "PAIRS_AT_ONCE", 10)
    rng = random.Random(4)
    lists = [sorted(rng.sample(range(10**9, 10**9 + 40), rng.choice([2, 2, 3, 5, 8, 17]))) for _ in range(60)]
    refs, sizes = np.array([x for one in lists for x in one]), np.array([len(one) for one in lists])
    expected = sorted({pair for one in lists for pair in itertools.combinations(one, 2)})
    for some, count in ((refs, sizes), partition_join.cut(refs.astype(np.uint64), sizes)[:2]):
        names, found = pairs_in(some.astype(np.int64), count)
        assert sorted(zip(names[found >> 32].tolist(), names[found & 0xFFFFFFFF].tolist(), strict=True)) == expected


def prose(rng, count, words):
    return [" ".join(f"{rng.randrange(36**4):x}" for _ in range(words + i % 40)) for i in range(count)]


def test_large_sets_that_do_not_meet_are_not_compared(spark, monkeypatch):
    """Unrelated large sets of like size make no comparison, whatever their number; all were compared with all."""
    rng = random.Random(5)
    compared, similar = [], []
    near = partition_join.pairs_in
    for count in (100, 400):
        texts = prose(rng, count, 300)
        texts += [t.replace(" 1", " 2", 3) + " tail" for t in texts[:10]]
        frame = storage.durable(spark.createDataFrame(list(enumerate(texts)), "group_id bigint, normalized string"))
        lists = partition_join.token_lists(partition_join.signed(frame, K, 0.8, 545, 16).repartition(4, "bucket"), 16)
        rows = storage.durable(partition_join.met_in_parts(lists, 4)).filter("pairs is not null")
        compared.append(rows.agg(F.sum(F.length("pairs") / 8)).first()[0])
        monkeypatch.setattr(jaccard_join, "large_candidates", None)
        similar.append({(r.id1, r.id2) for r in jaccard_join.similar_pairs(frame, K, 0.8).collect()})
        assert similar[-1] == {(i, count + i) for i in range(10)}
    assert near is partition_join.pairs_in and max(compared) <= 16 * 10


def test_sets_beyond_tokens_are_compared_by_bitmaps(spark, monkeypatch):
    """Sets with too few tokens, made so here, and those of long texts are still found, by bitmaps and only for their own pairs."""
    monkeypatch.setattr(partition_join, "SPARE", 0.9)
    rng = random.Random(6)
    texts = prose(rng, 30, 300)
    texts += [t + " tail" for t in texts]
    frame = storage.durable(spark.createDataFrame(list(enumerate(texts)), "group_id bigint, normalized string"))
    many, weak = partition_join.token_candidates(frame, K, 0.8, 545)
    assert not weak.isEmpty()
    sets = [brute.shingle_set(t, K) for t in texts]
    expected = {
        (i, j): len(sets[i] & sets[j])
        for i, j in itertools.combinations(range(len(sets)), 2)
        if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8
    }
    assert {(r.id1, r.id2): r.shared for r in jaccard_join.similar_pairs(frame, K, 0.8).collect()} == expected and len(expected) >= 30


def test_odd_sets_meet_all_others_and_no_others_meet(spark):
    sizes = [700, 710, 720, 730, 800, 2000]
    rows = [(i, n, bytearray(128), i in (1, 4)) for i, n in enumerate(sizes)]
    sets = storage.durable(spark.createDataFrame(rows, "group_id bigint, size bigint, parity binary, odd boolean"))
    got = sorted((r.id1, r.id2) for r in jaccard_join.large_candidates(sets, 0.8).collect())
    assert got == [(0, 1), (0, 4), (1, 2), (1, 3), (1, 4), (2, 4), (3, 4)]


@pytest.mark.parametrize("most", [1 << 10, 4 << 20])
def test_overlaps_of_pairs(monkeypatch, most):
    monkeypatch.setattr(jaccard_join, "MATRIX_BYTES", most)
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 32, 400)
    sets = [np.unique(np.append(base[rng.random(400) < 0.8], rng.integers(0, 1 << 32, i))) for i in range(30)] + [base[:0]]
    a, b = (x.ravel() for x in np.mgrid[0:31, 0:31])
    got = jaccard_join.overlaps(np.concatenate(sets), np.array([len(s) for s in sets]), a, b)
    assert got.tolist() == [len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b, strict=True)]
    assert not len(jaccard_join.overlaps(np.concatenate(sets), np.array([len(s) for s in sets]), a[:0], b[:0]))
