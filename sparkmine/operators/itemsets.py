"""Frequent itemsets by level-wise A-Priori.

An itemset is a sorted array without repeats. Baskets are reduced before any level is counted: only
frequent items are kept, which bounds a basket by the number of frequent items however long it was,
and equal baskets become one row with a weight. They are kept as vertical bitmaps, and a level is a pass over these with
candidates that its tasks know. From a level on whose candidates are too many to broadcast, a level is a scan of the reduced
baskets, a chain of joins that extends prefixes inside each basket, and one aggregation that combines on the map side.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.operators import vertical
from sparkmine.operators.skew import lookup_join, lookup_semi, pairs_sharing_key
from sparkmine.operators.storage import durable, release, small

PART_ITEMS = 1_000  # items of a basket in one array
CANDIDATE_ITEMS = 1 << 22  # items of all candidates of a level that tasks are told, four bytes each


def check_share(name: str, value: float) -> float:
    if not 0 < value <= 1:
        raise ValueError(f"{name} must be above 0 and at most 1")
    return value


def basket_items(rows: DataFrame, basket: str, item: str) -> DataFrame:
    """``tid, item`` without repeats, from a table with one row per basket and item."""
    return rows.select(F.col(basket).alias("tid"), F.col(item).alias("item")).dropna().distinct()


def exploded(baskets: DataFrame) -> DataFrame:
    """``tid, item`` from baskets held as ``tid, items``."""
    return baskets.select("tid", F.explode(F.array_distinct("items")).alias("item"))


def gathered(items: DataFrame, part_items: int = PART_ITEMS) -> DataFrame:
    """``tid, part, items``: the sorted items of each basket in parts of ``part_items``, numbered from 0.

    For reports; a level never needs whole baskets. No array is longer than a part. Items are put in order by a range sort,
    so a basket of any length is spread over many tasks; an item's place is its place in its range and what the ranges before
    hold of the basket.
    """
    order = ["tid", "item"]
    placed = items.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = durable(placed.withColumn("range_no", F.spark_partition_id()), "placed")
    held = placed.groupBy("tid", "range_no").agg(F.count(F.lit(1)).alias("held"))
    before = F.sum("held").over(Window.partitionBy("tid").orderBy("range_no")) - F.col("held")
    cut = held.select("tid", "range_no", before.alias("before")).filter("before > 0")  # one per range, at most
    place = F.row_number().over(Window.partitionBy("tid", "range_no").orderBy("item")) - 1
    found = placed.withColumn("place", place).join(F.broadcast(cut), ["tid", "range_no"], "left")
    part = F.floor((F.col("place") + F.coalesce("before", F.lit(0))) / F.lit(part_items)).cast("int")
    return found.groupBy("tid", part.alias("part")).agg(F.sort_array(F.collect_list("item")).alias("items"))


def basket_count(items: DataFrame) -> int:
    """Number of baskets."""
    return items.agg(F.count_distinct("tid")).first()[0]


def item_counts(items: DataFrame) -> DataFrame:
    """``itemset, cnt`` for single items."""
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("cnt")).select(
        F.array("item").alias("itemset"), "cnt"
    )


def at_least(counts: DataFrame, min_count: float) -> DataFrame:
    """Itemsets that reach the support bound."""
    return counts.filter(F.col("cnt") >= F.lit(float(min_count)))


def reduced_baskets(items: DataFrame, level1: DataFrame) -> DataFrame:
    """``items, weight``: distinct baskets of two or more frequent items.

    ``level1`` has at most ``rows / min_count`` rows and no basket keeps more items than that.
    """
    frequent = level1.select(F.col("itemset")[0].alias("item"))
    return (
        lookup_semi(items, frequent, ["item"])
        .groupBy("tid")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .filter(F.size("items") > 1)
        .groupBy("items")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def _prefix(itemset: str) -> Column:
    return F.slice(itemset, 1, F.size(itemset) - 1)


def joined_candidates(level: DataFrame) -> DataFrame:
    """Itemsets one longer, from two frequent ones that differ in the last item only.

    Itemsets that share a prefix with very many others are joined block against block.
    """
    split = durable(level.select(_prefix("itemset").alias("prefix"), F.element_at("itemset", -1).alias("last")), "split")
    pairs = pairs_sharing_key(split, ["prefix"], "last", carry=[F.col("x.prefix").alias("prefix")])
    return pairs.select(F.concat("prefix", F.array("id1", "id2")).alias("itemset"))


def pruned_candidates(level: DataFrame, k: int) -> DataFrame:
    """Candidates of size ``k`` all of whose subsets of size ``k - 1`` are in ``level``."""
    candidates = joined_candidates(level)
    subsets = candidates.select(
        "itemset",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.lit(k)),
                lambda i: F.concat(
                    F.slice("itemset", 1, i - 1), F.slice("itemset", i + 1, F.lit(k))
                ),
            )
        ).alias("subset"),
    )
    present = lookup_join(subsets, durable(level.select(F.col("itemset").alias("subset")), "subsets"), ["subset"])
    return present.groupBy("itemset").count().filter(F.col("count") == k).select("itemset")


def _extend(held: DataFrame, known: DataFrame, fits: bool) -> DataFrame:
    """Grow each itemset held by a basket to those of ``known`` that the basket holds, too.

    Known itemsets too many to broadcast are joined by shuffle; a prefix that most baskets hold is salted.
    """
    steps = known.select(_prefix("itemset").alias("held"), F.element_at("itemset", -1).alias("last"))
    return (
        lookup_join(held, steps, ["held"], fits=fits)
        .filter(F.array_contains("items", F.col("last")))
        .select("items", "weight", F.concat("held", F.array("last")).alias("held"))
    )


def _sum_weights(held: DataFrame) -> DataFrame:
    return held.groupBy(F.col("held").alias("itemset")).agg(F.sum("weight").alias("cnt"))


def pair_counts(baskets: DataFrame) -> DataFrame:
    """``itemset, cnt`` of size 2: every two frequent items of a basket are a candidate."""
    held = baskets.select("items", "weight", F.explode("items").alias("item"))
    later = F.filter("items", lambda other: other > F.col("item"))
    pairs = held.select("weight", "item", F.explode(later).alias("other"))
    return _sum_weights(pairs.select("weight", F.array("item", "other").alias("held")))


def candidate_counts(baskets: DataFrame, steps: list[tuple[DataFrame, bool]]) -> DataFrame:
    """``itemset, cnt`` of the last table in ``steps``, counted in reduced baskets.

    ``steps`` are the frequent itemsets of size 2, 3 … and at last the candidates, each with whether it
    may be broadcast. They are joined one after the other inside each basket, and nothing is kept
    between levels but the frequent itemsets.
    """
    held = baskets.select("items", "weight", F.explode("items").alias("item"))
    held = held.select("items", "weight", F.array("item").alias("held"))
    for known, fits in steps:
        held = _extend(held, known, fits)
    return _sum_weights(held)


def frequent_levels(
    items: DataFrame, min_count: float, max_k: int | None = None, partitions: int | None = None
) -> dict[int, DataFrame]:
    """``{k: itemset, cnt}`` for every non-empty level. ``items`` is read twice: pass a durable table.

    ``partitions`` deals the reduced baskets over so many tasks; they may be few rows for much work.
    """
    level = durable(at_least(item_counts(items), min_count), "level1")
    if level.isEmpty():
        return {}
    levels = {1: level}
    if max_k == 1:
        return levels
    baskets = reduced_baskets(items, level)
    if partitions:
        baskets = baskets.repartition(partitions, "items")
    baskets = durable(baskets, "baskets")
    done = _count_by_bitmaps(baskets, levels, min_count, max_k) if small(level) else False
    if not done:
        _count_by_joins(baskets, levels, min_count, max_k)
    release(baskets)
    return levels


def _count_by_bitmaps(
    baskets: DataFrame, levels: dict[int, DataFrame], min_count: float, max_k: int | None
) -> bool:
    """Add to ``levels`` while the candidates of a level are few enough to broadcast; whether that was to the end."""
    spark = baskets.sparkSession
    schema = levels[1].schema
    names = sorted(r.item for r in levels[1].select(F.col("itemset")[0].alias("item")).collect())
    ranges = durable(vertical.bitmap_ranges(baskets, names), "ranges")
    level = [(i,) for i in range(len(names))]
    for k in itertools.count(2):
        if max_k is not None and k > max_k:
            break
        if vertical.joined(level) * k > CANDIDATE_ITEMS:
            release(ranges)
            return False
        candidates = vertical.grown(level)
        if not candidates:
            break
        counted = at_least(vertical.candidate_counts(ranges, np.array(candidates, np.int32)), min_count).collect()
        found = sorted((candidates[r.candidate], r.cnt) for r in counted)
        if not found:
            break
        rows = [([names[i] for i in itemset], cnt) for itemset, cnt in found]
        levels[k] = durable(spark.createDataFrame(rows, schema), f"level{k}")
        level = [itemset for itemset, _ in found]
    release(ranges)
    return True


def _count_by_joins(
    baskets: DataFrame, levels: dict[int, DataFrame], min_count: float, max_k: int | None
) -> None:
    """Add the levels that are not in ``levels`` yet."""
    steps = [(levels[k], small(levels[k])) for k in sorted(levels) if k > 1]
    for k in itertools.count(len(levels) + 1):
        if max_k is not None and k > max_k:
            break
        if k == 2:
            counts = pair_counts(baskets)
        else:
            candidates = durable(pruned_candidates(levels[k - 1], k), f"candidates{k}")
            if candidates.isEmpty():
                break
            counts = candidate_counts(baskets, [*steps, (candidates, small(candidates))])
        level = durable(at_least(counts, min_count), f"level{k}")
        if level.isEmpty():
            break
        levels[k] = level
        steps.append((level, small(level)))


def no_itemsets(items: DataFrame) -> DataFrame:
    """An empty level for ``items(tid, item)``."""
    return item_counts(items).limit(0)


def itemset_table(levels: dict[int, DataFrame], n_baskets: int, like: DataFrame) -> DataFrame:
    """``k, itemset, cnt, support`` over all levels."""
    table = no_itemsets(like).withColumn("k", F.lit(0))
    for k, level in levels.items():
        table = table.unionByName(level.withColumn("k", F.lit(k)))
    return table.select("k", "itemset", "cnt", (F.col("cnt") / F.lit(n_baskets)).alias("support"))


def report(itemsets: DataFrame) -> DataFrame:
    """By size, most frequent first."""
    return itemsets.orderBy("k", F.desc("cnt"), "itemset")


def totals(itemsets: DataFrame) -> DataFrame:
    """``k, itemsets``: number of frequent itemsets per size, and over all sizes where k is NULL."""
    return itemsets.rollup("k").agg(F.count(F.lit(1)).alias("itemsets"))
