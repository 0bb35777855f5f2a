"""Triangle estimates from a sampled edge stream (TRIEST, De Stefani et al. 2016, improved variant)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.edges import both_ways
from sparkmine.operators.order import running_total
from sparkmine.operators import skew
from sparkmine.operators.skew import heavy_keys, lookup_join, lookup_semi, salted_join
from sparkmine.operators.storage import BROADCAST_BYTES, durable, small


def edge_weight(t: Column, size: Column) -> Column:
    """1 while the reservoir fills, then (t−1)(t−2) / (M(M−1))."""
    t, m = t.cast("double"), size.cast("double")
    return F.when(t <= m, F.lit(1.0)).otherwise((t - 1) * (t - 2) / (m * (m - 1)))


def sampled_neighbors(lives: DataFrame) -> DataFrame:
    """``x, y, run, t_in, t_out``: adjacency of the sample over time."""
    return both_ways(lives, "run", "t_in", "t_out")


def _alive(t: str, t_in: str, t_out: str) -> Column:
    """Seen by the edge at ``t``: counting comes before replacement."""
    return (F.col(t_in) < F.col(t)) & (F.col(t_out).isNull() | (F.col(t_out) >= F.col(t)))


def contributions(edges: DataFrame, lives: DataFrame) -> DataFrame:
    """``run, size, t, common``: for each edge that closes triangles with the sample, how many.

    Per edge and run, the end with fewer sampled neighbours lists them and the other end is looked
    up, so that a hub's neighbours are listed only for edges between two hubs. The tables made from the
    sample are broadcast if the bytes of the sample allow; if not, the joins shuffle with salts, for
    a hub arrives often. ``lives`` should be durable: it is read several times.
    """
    fits = small(lives, BROADCAST_BYTES // 2)  # both_ways doubles it; degrees are fewer
    hops = sampled_neighbors(lives)
    degrees = hops.groupBy("run", "x").agg(F.count(F.lit(1)).alias("degree"))
    of_a = degrees.select("run", F.col("x").alias("a"), F.col("degree").alias("da"))
    of_b = degrees.select("run", F.col("x").alias("b"), F.col("degree").alias("db"))
    ends = lookup_join(edges.select("t", "a", "b"), of_a, ["a"], fits=fits)
    ends = lookup_join(ends, of_b, ["run", "b"], fits=fits)
    a_lists = F.col("da") <= F.col("db")
    sides = ends.select(
        "run",
        "t",
        F.when(a_lists, F.col("a")).otherwise(F.col("b")).alias("x"),
        F.when(a_lists, F.col("b")).otherwise(F.col("a")).alias("other"),
    )
    first = hops.select("run", "x", "y", "t_in", "t_out")
    legs = (
        lookup_join(sides, first, ["run", "x"], fits=fits)
        .filter(_alive("t", "t_in", "t_out"))
        .select("run", "t", "other", "y")
    )
    second = hops.select("run", F.col("x").alias("other"), "y", "t_in", "t_out")
    keys = ["run", "other", "y"]
    if fits:
        closed = legs.join(F.broadcast(second), keys)
    else:
        legs = durable(legs, "legs")  # counted and joined
        closed = salted_join(legs, second, keys, heavy=heavy_paths(legs))
    counted = closed.filter(_alive("t", "t_in", "t_out")).groupBy("run", "t").agg(F.count(F.lit(1)).alias("common"))
    sizes = lives.select("run", "size").distinct()  # a row per run
    return counted.join(F.broadcast(sizes), "run").select("run", "size", "t", "common")


def heavy_paths(legs: DataFrame) -> DataFrame:
    """:func:`heavy_keys` of ``run, other, y``. Only paths from a node with as many legs can be heavy, so no others are counted."""
    nodes = heavy_keys(legs, ["run", "other"], skew.SALT_ROWS)
    return heavy_keys(lookup_semi(legs, nodes.select("run", "other"), ["run", "other"]), ["run", "other", "y"], skew.SALT_ROWS)


def weighted(parts: DataFrame) -> DataFrame:
    """Add ``gain``, what the edge adds to the estimate."""
    return parts.withColumn("gain", F.col("common") * edge_weight(F.col("t"), F.col("size")))


def estimate(parts: DataFrame, lives: DataFrame) -> DataFrame:
    """``run, size, estimate`` for every run, 0 for a run without triangles."""
    sums = parts.transform(weighted).groupBy("run").agg(F.sum("gain").alias("estimate"))
    runs = lives.select("run", "size").distinct()
    return runs.join(sums, "run", "left").select(
        "run", "size", F.coalesce("estimate", F.lit(0.0)).alias("estimate")
    )


def history(edges: DataFrame, parts: DataFrame, every: int, n_edges: int) -> DataFrame:
    """``t, estimate`` at every ``every``-th edge, as whole numbers, for a single run."""
    if every <= 0:
        raise ValueError("every must be positive")
    step = (F.floor((F.col("t") - 1) / every) + 1).alias("step")
    gains = parts.transform(weighted).groupBy(step).agg(F.sum("gain").alias("gain"))
    steps = edges.filter(F.col("t") % every == 0).select((F.col("t") / every).cast("bigint").alias("step"))
    filled = steps.join(gains, "step", "left").select("step", F.coalesce("gain", F.lit(0.0)).alias("gain"))
    summed = running_total(durable(filled, "steps"), "step", "gain", "estimate", n_edges // every)
    return summed.select((F.col("step") * every).alias("t"), whole(F.col("estimate")).alias("estimate"))


def whole(value: Column) -> Column:
    """Cut to a whole number, as a report shows it."""
    return value.cast("bigint")


def with_errors(estimates: DataFrame, exact: DataFrame) -> DataFrame:
    """Add ``triangles, abs_error, rel_error, band``; without triangles the ratio is NULL.

    ``exact`` is a table of one number.
    """
    compared = estimates.withColumn("triangles", exact.scalar()).withColumn(
        "abs_error", F.abs(F.col("estimate") - F.col("triangles"))
    )
    rel = F.try_divide(F.col("abs_error"), F.col("triangles").cast("double"))
    return compared.withColumn("rel_error", rel).withColumn("band", accuracy_band(F.col("rel_error")))


def accuracy_band(rel_error: Column) -> Column:
    """The name of an error's size; NULL stays NULL."""
    # The bands.
    return (
        F.when(rel_error < 0.10, "excellent")
        .when(rel_error < 0.20, "good")
        .when(rel_error.isNotNull(), "high variance")
    )
