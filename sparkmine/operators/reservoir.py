"""Reservoir sampling as a relation.

Whether a row enters and which slot it takes depend on its position and on two draws only, never on
the reservoir's content. So the whole history is a filter and one window per slot: a row leaves when the
next row enters its slot. A slot sees about 1 + ln(rows / size) rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.functions.draws import uniform


@dataclass(frozen=True)
class Run:
    """One sampling run: reservoir size and seed."""

    size: int
    seed: int = 42

    def __post_init__(self) -> None:
        if self.size < 2:
            raise ValueError("a reservoir needs at least two rows for a triangle to be seen")


def lifetimes(rows: DataFrame, runs: Sequence[Run], value_cols: Sequence[str]) -> DataFrame:
    """``run, size, slot, t_in, t_out`` and the sampled row; ``t_out`` is NULL for rows that stay.

    ``rows`` has positions ``t`` from 1. ``run`` numbers ``runs`` from 1; all of them are drawn in one
    pass. The row that arrives at ``t`` meets the rows with ``t_in < t`` that have not left before t.
    """
    config = F.array(
        *[
            F.struct(
                F.lit(i).alias("run"), F.lit(run.size).alias("size"), F.lit(run.seed).alias("seed")
            )
            for i, run in enumerate(runs, 1)
        ]
    )
    drawn = rows.select("t", *value_cols, F.explode(config).alias("c")).select(
        "t", *value_cols, "c.run", "c.size", "c.seed"
    )
    accept = uniform(F.concat(F.col("seed"), F.lit("a")), F.col("t"))
    place = uniform(F.concat(F.col("seed"), F.lit("s")), F.col("t"))
    fills = F.col("t") <= F.col("size")
    slot = F.when(fills, F.col("t") - 1).otherwise(F.floor(place * F.col("size")))
    by_slot = Window.partitionBy("run", "slot").orderBy("t")
    return (
        drawn.filter(fills | (accept < F.col("size") / F.col("t")))
        .withColumn("slot", slot.cast("bigint"))
        .withColumn("t_out", F.lead("t").over(by_slot))
        .select("run", "size", "slot", F.col("t").alias("t_in"), "t_out", *value_cols)
    )


def sample_at(lives: DataFrame, t: int | Column | None = None) -> DataFrame:
    """Reservoir content after the row at position ``t``, or at the end."""
    if t is None:
        return lives.filter(F.col("t_out").isNull())
    return lives.filter((F.col("t_in") <= t) & (F.col("t_out").isNull() | (F.col("t_out") > t)))


def replacement_log(lives: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    """One row per row that came in: ``run, t, slot``, the row, and as ``old_*`` the one that left."""
    by_slot = Window.partitionBy("run", "slot").orderBy("t_in")
    old = [F.lag(c).over(by_slot).alias(f"old_{c}") for c in value_cols]
    return lives.select("run", F.col("t_in").alias("t"), "slot", *value_cols, *old)
