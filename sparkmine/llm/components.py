"""Connected components of an edge table by alternating stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.tables import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each vertex's neighbours on the least vertex around it.

    Large star: the neighbours above it, counting all edges from both ends. Small star: those below it.
    """
    if large:
        around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(least, "u")
    if large:
        hung = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.unionByName(least.select("u", F.col("m").alias("v")))
    return hung.filter("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` for the vertices of ``edges(u, v)`` that are not the least of their component.

    Ids may be of any type that has an order. Every round writes its edges, which are no more than before;
    the least id is reached after a number of rounds that grows like the square of the logarithm.
    """
    current = scratch.write("edges_0", edges.filter("u <> v").select("u", "v").distinct())
    state, number = None, 0
    while True:
        sign = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003))
        new = tuple(sign.first())
        if new == state or not new[0]:
            break
        state, number = new, number + 1
        current = scratch.write(f"edges_{number}", _star(_star(current, True), False), (f"edges_{number - 1}",))
        scratch.drop(f"edges_{number - 1}")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
