"""How well candidate pairs agree with the exact result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label(verified: DataFrame, threshold: float) -> DataFrame:
    """Mark verified candidates: ``is_similar`` is true for true and false for false positives."""
    return verified.withColumn("is_similar", F.col("jaccard") >= threshold)


def quality(
    groups: DataFrame, similar: DataFrame, candidates: DataFrame, missed: DataFrame
) -> DataFrame:
    """One row of document-pair counts with recall and precision; a ratio without pairs is NULL.

    ``similar`` are the candidates that are similar and ``missed`` the similar pairs that are no
    candidates, both with ``copies1`` and ``copies2``; ``candidates`` has counts ``pairs``, to be summed.
    Pairs inside a group are counted from its size: they share every bucket and are similar.
    """
    product = (F.col("copies1").cast("decimal(18,0)") * F.col("copies2").cast("decimal(18,0)")).cast(
        "decimal(38,0)"
    )
    n = F.col("copies").cast("decimal(18,0)")
    inside = (n * (n - 1) / 2).cast("decimal(38,0)")
    counted = (
        groups.select(F.lit("inside").alias("kind"), inside.alias("pairs"))
        .union(similar.select(F.lit("similar"), product))
        .union(candidates.select(F.lit("candidates"), "pairs"))
        .union(missed.select(F.lit("missed"), product))
    )

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("pairs"))), F.lit(0)).alias(kind)

    counts = counted.agg(*[total(k) for k in ("inside", "similar", "candidates", "missed")]).select(
        (F.col("inside") + F.col("similar")).cast("decimal(38,0)").alias("true_positives"),
        (F.col("candidates") - F.col("similar")).cast("decimal(38,0)").alias("false_positives"),
        F.col("missed").cast("decimal(38,0)").alias("false_negatives"),
    )
    tp, fp, fn = (F.col(c).cast("double") for c in counts.columns)
    return counts.select(
        "*",
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(tp, tp + fp).alias("precision"),
    )
