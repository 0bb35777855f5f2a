"""Association rules from frequent itemsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.itemsets import check_share
from sparkmine.operators.skew import lookup_join
from sparkmine.operators.storage import durable, small


def _confident(rows: DataFrame, counts: DataFrame, fits: bool, min_confidence: float) -> DataFrame:
    """Rules that reach the confidence. Counts too many to broadcast are joined with salts: an item may be in all rules."""
    known = counts.select(F.col("itemset").alias("antecedent"), F.col("cnt").alias("antecedent_cnt"))
    split = rows.withColumn("antecedent", F.array_except("itemset", "consequent"))
    return (
        lookup_join(split, known, ["antecedent"], fits=fits)
        .withColumn("confidence", F.col("cnt") / F.col("antecedent_cnt"))
        .filter(F.col("confidence") >= F.lit(float(min_confidence)))
        .select("itemset", "cnt", "antecedent", "consequent", "confidence")
    )


def confident_splits(itemsets: DataFrame, max_k: int, min_confidence: float) -> DataFrame:
    """Every split of an itemset into antecedent and consequent that reaches the confidence.

    Consequents grow by one item per round, and only from those that passed: a longer consequent
    leaves a shorter antecedent, whose count is at least as high, so the confidence can only fall.
    Adding only items above the largest reaches each consequent once. The work follows the number of
    rules, not the number of subsets.
    """
    counts = durable(itemsets.select("itemset", "cnt"), "counts")
    fits = small(counts)
    start = counts.filter(F.size("itemset") > 1).withColumn("item", F.explode("itemset"))
    grown = start.select("itemset", "cnt", F.array("item").alias("consequent"))
    passed = _confident(grown, counts, fits, min_confidence)
    found = None
    for size in range(1, max_k):
        passed = durable(passed, f"rules{size}")
        found = passed if found is None else found.unionByName(passed)
        if passed.isEmpty():
            break
        grown = (
            passed.filter(F.size("antecedent") > 1)
            .withColumn("item", F.explode("antecedent"))
            .filter(F.col("item") > F.element_at("consequent", -1))
            .select("itemset", "cnt", F.concat("consequent", F.array("item")).alias("consequent"))
        )
        passed = _confident(grown, counts, fits, min_confidence)
    return passed.limit(0) if found is None else found


def association_rules(
    itemsets: DataFrame, n_baskets: int, min_confidence: float, max_k: int
) -> DataFrame:
    """``antecedent, consequent, support_cnt, support, confidence, lift``.

    ``itemsets`` has ``itemset, cnt`` for every frequent itemset up to size ``max_k``.
    """
    check_share("min_confidence", min_confidence)
    splits = confident_splits(itemsets, max_k, min_confidence)
    known = durable(itemsets.select(F.col("itemset").alias("consequent"), F.col("cnt").alias("consequent_cnt")), "counts")
    share = F.col("consequent_cnt") / F.lit(n_baskets)
    return lookup_join(splits, known, ["consequent"]).select(
        "antecedent",
        "consequent",
        F.col("cnt").alias("support_cnt"),
        (F.col("cnt") / F.lit(n_baskets)).alias("support"),
        "confidence",
        F.when(share == 0, F.lit(0.0)).otherwise(F.col("confidence") / share).alias("lift"),
    )


def report(rules: DataFrame) -> DataFrame:
    """Highest lift first."""
    return rules.orderBy(F.desc("lift"), "antecedent", "consequent")
