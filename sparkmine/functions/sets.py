"""Similarity of sets and signatures held in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard_of_counts(shared: Column, size1: Column, size2: Column) -> Column:
    """Jaccard similarity from the intersection size and the two set sizes; two empty sets give 1."""
    union = size1 + size2 - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def jaccard(set1: Column, set2: Column) -> Column:
    """Jaccard similarity of two arrays without repeats."""
    return jaccard_of_counts(F.size(F.array_intersect(set1, set2)), F.size(set1), F.size(set2))


def signature_similarity(sig1: Column, sig2: Column) -> Column:
    """Share of positions at which two signatures agree.

    Fails on signatures of different length; two signatures without positions give 1.
    """
    same = F.size(F.filter(F.zip_with(sig1, sig2, lambda a, b: a == b), lambda eq: eq))
    unequal = F.raise_error(F.lit("signatures must have the same length")).cast("double")
    return (
        F.when(F.size(sig1) != F.size(sig2), unequal)
        .when(F.size(sig1) == 0, F.lit(1.0))
        .otherwise(same / F.size(sig1))
    )
