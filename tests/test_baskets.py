import random

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from sparkmine.operators import itemsets as ops
from sparkmine.operators import rules as rule_ops
from sparkmine.operators import skew, vertical
from sparkmine.operators.storage import durable
from sparkmine.plans.baskets import MarketBaskets
from tests import brute

SMALL = ["abc", "ab", "ac", "bc", "abc", "d"]


def random_baskets():
    rng = random.Random(5)
    items = "abcdefghij"
    weights = [9, 8, 8, 7, 5, 4, 3, 2, 1, 1]
    baskets = [set(rng.choices(items, weights, k=rng.randrange(1, 9))) for _ in range(150)]
    return ["".join(sorted(b)) for b in baskets] + ["".join(items)]  # the last holds everything


def rows_of(spark, baskets):
    rows = [(t, i) for t, basket in enumerate(baskets) for i in basket]
    return spark.createDataFrame(rows, "basket bigint, thing string")


def items_of(spark, baskets):
    return ops.basket_items(rows_of(spark, baskets), "basket", "thing")


def found(job):
    return {tuple(r.itemset): r.cnt for r in job.itemsets.collect()}


@pytest.mark.parametrize("support", [0.02, 0.3])
@pytest.mark.parametrize("baskets", [SMALL, random_baskets()], ids=["small", "random"])
def test_itemsets(spark, baskets, support):
    job = MarketBaskets(items_of(spark, baskets), support)
    assert job.n_baskets == len(baskets)
    assert found(job) == brute.frequent(baskets, len(baskets) * support)


@pytest.mark.parametrize("told", [0, 200])
def test_itemsets_when_candidates_are_too_many_to_tell(spark, monkeypatch, told):
    """All levels by joins, or the first ones by bitmaps and the others by joins."""
    monkeypatch.setattr(ops, "CANDIDATE_ITEMS", told)
    baskets = random_baskets()
    job = MarketBaskets(items_of(spark, baskets), 0.02)
    assert found(job) == brute.frequent(baskets, len(baskets) * 0.02)


@pytest.mark.parametrize("limit", ["RANGE", "RANGE_BYTES"])
def test_baskets_in_many_ranges(spark, monkeypatch, limit):
    monkeypatch.setattr(vertical, limit, 64)
    baskets = random_baskets() + ["abc"] * 77 + ["bd"] * 5  # equal baskets are one row with a weight
    job = MarketBaskets(items_of(spark, baskets), 0.03, partitions=2)
    assert found(job) == brute.frequent(baskets, len(baskets) * 0.03)


def test_a_basket_of_a_million_items(spark):
    """Its items come in order, in parts, from many ranges; no array is longer than a part."""
    long = spark.range(1_000_000).selectExpr("7L tid", "format_string('%07d', id) item")
    short = spark.createDataFrame([(3, "b"), (3, "a"), (9, "z")], "tid bigint, item string")
    parts = durable(ops.gathered(long.unionByName(short)))
    assert parts.agg(F.max(F.size("items"))).first()[0] == ops.PART_ITEMS
    whole = parts.filter("tid = 7")
    ends = whole.select("part", F.element_at("items", 1).alias("a"), F.element_at("items", -1).alias("b")).collect()
    n = ops.PART_ITEMS
    assert sorted(map(tuple, ends)) == [(i, f"{i * n:07d}", f"{(i + 1) * n - 1:07d}") for i in range(1_000_000 // n)]
    assert sorted(map(tuple, parts.filter("tid <> 7").collect())) == [(3, 0, ["a", "b"]), (9, 0, ["z"])]


def test_an_item_in_every_pair(spark, monkeypatch):
    """Hot prefix and hot subsets: cut into blocks and salted, the same candidates."""
    items = [f"i{n:02}" for n in range(30)]
    pairs = [["a", i] for i in items] + [list(p) for p in zip(items, items[1:], strict=False)]
    frame = spark.createDataFrame([(p, 1) for p in pairs], "itemset array<string>, cnt bigint")
    expected = sorted(["a", *p] for p in zip(items, items[1:], strict=False))
    assert sorted(r[0] for r in ops.pruned_candidates(frame, 3).collect()) == expected
    monkeypatch.setattr(skew, "BLOCK_ROWS", 4)
    monkeypatch.setattr(skew, "SALT_ROWS", 3)
    monkeypatch.setattr(skew, "small", lambda table: False)
    assert sorted(r[0] for r in ops.pruned_candidates(frame, 3).collect()) == expected
    assert vertical.grown(sorted(map(tuple, pairs))) == [tuple(c) for c in expected]


def test_rules_with_one_item_in_all_itemsets(spark, monkeypatch):
    """The antecedent's count is looked up for every rule: salted where it is too hot to join and too big to broadcast."""
    baskets = [f"a{x}{y}" for x in "bcdefgh" for y in "ijk"] * 2
    job = MarketBaskets(items_of(spark, baskets), 0.01, 0.04)  # pairs are bought with a in one of 21
    expected = sorted(map(tuple, job.rules.collect()))
    assert len([r for r in expected if r[0] == ["a"]]) > 20
    monkeypatch.setattr(skew, "SALT_ROWS", 3)
    monkeypatch.setattr(rule_ops, "small", lambda table: False)
    monkeypatch.setattr(skew, "small", lambda table: False)
    assert sorted(map(tuple, MarketBaskets(items_of(spark, baskets), 0.01, 0.04).rules.collect())) == expected


def test_itemsets_equal_fpgrowth(spark):
    baskets = random_baskets()
    frame = spark.createDataFrame([(list(b),) for b in baskets], "items array<string>")
    model = FPGrowth(minSupport=0.05, minConfidence=0.1).fit(frame)
    theirs = {tuple(sorted(r["items"])): r.freq for r in model.freqItemsets.collect()}
    assert found(MarketBaskets(items_of(spark, baskets), 0.05)) == theirs


def test_repeated_items_count_once(spark):
    baskets = ["aab", "ab", "a"]
    assert found(MarketBaskets(items_of(spark, baskets), 0.5)) == {
        ("a",): 3,
        ("b",): 2,
        ("a", "b"): 2,
    }


def test_bound_is_inclusive(spark):
    counts = spark.createDataFrame([(["a"], 3), (["b"], 2)], "itemset array<string>, cnt bigint")
    assert ops.at_least(counts, 3).count() == 1
    assert ops.at_least(counts, 2.5).count() == 1
    assert ops.at_least(counts, 2.0).count() == 2


def test_candidates_need_all_subsets(spark):
    level = [["a", "b"], ["a", "c"], ["b", "c"], ["b", "d"], ["c", "e"]]
    frame = spark.createDataFrame([(s, 1) for s in level], "itemset array<string>, cnt bigint")
    assert sorted(r[0] for r in ops.joined_candidates(frame).collect()) == [
        ["a", "b", "c"],
        ["b", "c", "d"],
    ]
    assert [r[0] for r in ops.pruned_candidates(frame, 3).collect()] == [["a", "b", "c"]]


def test_baskets_are_reduced_before_counting(spark):
    baskets = ["abxyz", "abuvw", "ab", "c"]
    items = durable(items_of(spark, baskets))
    level = durable(ops.at_least(ops.item_counts(items), 2))
    assert [tuple(r) for r in ops.reduced_baskets(items, level).collect()] == [(["a", "b"], 3)]


def test_max_k_and_totals(spark):
    job = MarketBaskets(items_of(spark, SMALL), 0.3, max_k=2)
    assert sorted(job.levels) == [1, 2]
    totals = {r.k: r.itemsets for r in ops.totals(job.itemsets).collect()}
    assert totals == {1: 3, 2: 3, None: 6}
    report = [(r.k, r.cnt) for r in ops.report(job.itemsets).collect()]
    assert report == sorted(report, key=lambda r: (r[0], -r[1]))


@pytest.mark.parametrize("confidence", [0.2, 0.7])
@pytest.mark.parametrize("baskets", [SMALL, random_baskets()], ids=["small", "random"])
def test_rules(spark, baskets, confidence):
    job = MarketBaskets(items_of(spark, baskets), 0.05, confidence)
    sets = brute.frequent(baskets, len(baskets) * 0.05)
    expected = brute.rules(sets, len(baskets), confidence)
    rows = job.rules.collect()
    assert len(rows) == len(expected)
    for row in rows:
        cnt, conf, lift = expected[tuple(row.antecedent), tuple(row.consequent)]
        assert (row.support_cnt, row.confidence) == (cnt, conf)
        assert row.lift == pytest.approx(lift)
        assert row.support == cnt / len(baskets)
    lifts = [r.lift for r in rule_ops.report(job.rules).collect()]
    assert lifts == sorted(lifts, reverse=True)


def test_nothing_frequent(spark):
    job = MarketBaskets(items_of(spark, ["a", "b", "c"]), 0.9)
    assert job.levels == {}
    assert job.level(2).count() == job.candidates(3).count() == 0
    assert job.itemsets.columns == ["k", "itemset", "cnt", "support"]
    assert job.itemsets.count() == job.rules.count() == 0
    none = MarketBaskets(items_of(spark, ["a"]).limit(0), 0.5)
    assert none.n_baskets == 0 and none.itemsets.count() == 0


def test_parameters_are_checked(spark):
    items = items_of(spark, SMALL)
    with pytest.raises(ValueError):
        MarketBaskets(items, 0.0)
    with pytest.raises(ValueError):
        MarketBaskets(items, 0.5, 1.5)


def test_large_levels_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("sparkmine.operators.storage.BROADCAST_BYTES", -1)
    monkeypatch.setattr("sparkmine.operators.skew.SALT_ROWS", 5)
    baskets = random_baskets()
    assert found(MarketBaskets(items_of(spark, baskets), 0.1)) == brute.frequent(
        baskets, len(baskets) * 0.1
    )


def test_numbers_as_items(spark):
    rows = spark.createDataFrame([(1, 10), (1, 9), (2, 10), (2, 9)], "basket int, thing int")
    job = MarketBaskets(ops.basket_items(rows, "basket", "thing"), 0.5)
    assert found(job) == {(9,): 2, (10,): 2, (9, 10): 2}
    assert [r.items for r in ops.gathered(job.items).collect()] == [[9, 10], [9, 10]]
    again = ops.exploded(ops.gathered(job.items))
    assert again.select(F.col("item")).count() == 4
