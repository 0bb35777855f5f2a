"""Labelled rows for the classifiers, and what their training shares."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 12_000  # labelled rows that a classifier is fitted on, at most


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the row's labels are kept from training; a null id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)) == fold


def training_rows(
    documents: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, bound: int = SAMPLE_ROWS
) -> DataFrame:
    """``doc_id, text, label`` of at most ``bound`` labelled rows outside the held-out fold.

    Of more labelled ids, those with the least hash are taken, so the sample does not depend on order or
    partitions. An id that is labelled twice counts as 1 if any of its labels is 1; null ids and labels are
    left out. The ids are at most ``bound`` rows, which the join broadcasts. Of several rows of one id, that of the
    least text digest is taken.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .filter(~held_out(F.col("doc_id"), folds, fold))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min_by("text", F.md5("text")).alias("text")).select("doc_id", "text", "label")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
