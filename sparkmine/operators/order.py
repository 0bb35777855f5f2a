"""Row positions, prefix sums and stream order without a single-task window over the data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.operators.storage import durable

LOCAL_BITS = 33  # low bits of monotonically_increasing_id hold the position within the partition


def number_rows(df: DataFrame, order_by: Sequence[str], name: str = "t") -> DataFrame:
    """Add ``name``: positions 1, 2, 3 … in ``order_by``, which must be a total order.

    Rows are range-partitioned and sorted, each keeps its partition number and its place there, and
    the table is written; a count per partition then gives the offset to add. The offsets have one
    row per shuffle partition.
    """
    mid = F.monotonically_increasing_id()
    placed = durable(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("range_no", mid)
        .withColumn("place", F.col("range_no").bitwiseAND((1 << LOCAL_BITS) - 1))
        .withColumn("range_no", F.shiftright("range_no", LOCAL_BITS)),
        "numbered",
    )
    sizes = placed.groupBy("range_no").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.orderBy("range_no")) - F.col("size")
    offsets = sizes.select("range_no", before.alias("offset"))
    return (
        placed.join(F.broadcast(offsets), "range_no")
        .withColumn(name, F.col("offset") + F.col("place") + 1)
        .drop("range_no", "place", "offset")
    )


def first_n(numbered: DataFrame, n: int, name: str = "t") -> DataFrame:
    """Keep the first ``n`` positions."""
    return numbered.filter(F.col(name) <= n)


def shuffled_order(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Add ``shuffle_key``, a seeded pseudo-random order that is the same on every run.

    Order by ``shuffle_key`` and then ``key``.
    """
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return df.withColumn("shuffle_key", F.md5(text))


def running_total(df: DataFrame, order_col: str, value_col: str, name: str, n_rows: int) -> DataFrame:
    """Prefix sum of ``value_col`` over dense positions 1 … ``n_rows`` in ``order_col``.

    Positions are cut into about sqrt(n) runs: a window inside each run, and a window over the run
    totals, so no task sees more than about sqrt(n) rows.
    """
    width = max(1, math.isqrt(max(n_rows, 1)))
    runs = df.withColumn("run_no", F.floor((F.col(order_col) - 1) / width))
    totals = runs.groupBy("run_no").agg(F.sum(value_col).alias("run_sum"))
    before = F.coalesce(
        F.sum("run_sum").over(Window.orderBy("run_no").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    offsets = totals.select("run_no", before.alias("offset"))
    inside = Window.partitionBy("run_no").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return (
        runs.withColumn(name, F.sum(value_col).over(inside))
        .join(offsets, "run_no")
        .withColumn(name, F.col(name) + F.col("offset"))
        .drop("run_no", "offset")
    )
