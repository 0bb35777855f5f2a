"""Undirected edge streams: canonical edges, positions, neighbours, exact triangles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.operators.order import number_rows
from sparkmine.operators import skew
from sparkmine.operators.colours import colours_for, triangles_by_colour
from sparkmine.operators.skew import heavy_keys, salted_join
from sparkmine.operators.storage import durable


def canonical_edges(rows: DataFrame, u: str, v: str, order_by: Sequence[str]) -> DataFrame:
    """``a, b`` with a < b and ``first``, the struct of ``order_by`` at the edge's first arrival.

    Self-loops go; (u, v) and (v, u) are one edge and its first arrival counts.
    """
    return (
        rows.filter(F.col(u) != F.col(v))
        .groupBy(F.least(u, v).alias("a"), F.greatest(u, v).alias("b"))
        .agg(F.min(F.struct(*order_by)).alias("first"))
    )


def edge_positions(edges: DataFrame) -> DataFrame:
    """``t, a, b``: arriving edges numbered from 1 in the order of their first arrival."""
    return number_rows(edges, ["first"], "t").select("t", "a", "b")


def successive(rows: DataFrame, value: str, order_by: Sequence[str]) -> DataFrame:
    """``u, v, n``: each row's value and that of the next row in a total order.

    The next row is found by position, an equi-join, and not by a window over the whole table.
    """
    numbered = number_rows(rows.select(value, *order_by), order_by, "n")
    here = numbered.select("n", F.col(value).alias("u"))
    after = numbered.select((F.col("n") - 1).alias("n"), F.col(value).alias("v"))
    return here.join(after, "n")


def both_ways(edges: DataFrame, *carry: str) -> DataFrame:
    """``x, y`` and ``carry``: each edge seen from both of its ends."""
    ends = F.array(
        F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
        F.struct(F.col("b").alias("x"), F.col("a").alias("y")),
    )
    return edges.select(F.explode(ends).alias("end"), *carry).select("end.x", "end.y", *carry)


def node_degrees(edges: DataFrame) -> DataFrame:
    """``node, degree``: how many neighbours each node has."""
    return both_ways(edges).groupBy(F.col("x").alias("node")).agg(F.count(F.lit(1)).alias("degree"))


def neighbors_of(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, neighbor`` for the nodes in ``nodes(node)``."""
    wanted = nodes.select(F.col("node").alias("x")).distinct()
    return salted_join(both_ways(edges), wanted, ["x"]).select(
        F.col("x").alias("node"), F.col("y").alias("neighbor")
    )


def _with_degrees(edges: DataFrame, degrees: DataFrame) -> DataFrame:
    """``a, b, da, db``: edges with the degrees of both ends; a hub's edges are salted."""
    of_a = degrees.select(F.col("node").alias("a"), F.col("degree").alias("da"))
    of_b = degrees.select(F.col("node").alias("b"), F.col("degree").alias("db"))
    half = salted_join(edges.select("a", "b"), of_a, ["a"])
    return salted_join(half, of_b, ["b"], heavy=heavy_keys(edges, ["b"], skew.SALT_ROWS))


def exact_triangles(edges: DataFrame, colours: int | None = None) -> DataFrame:
    """One row ``triangles``, by colours of nodes: as many as the number of edges asks for, unless given.

    ``edges`` is read twice: pass a durable table.
    """
    return triangles_by_colour(edges, colours or colours_for(edges.count()))


def common_neighbors(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """``a, b, common``: number of common neighbours of each pair; 0 if a node is unknown.

    The end of lower degree lists its neighbours, the other end is looked up. So a hub is only
    listed for pairs of hubs. A node in many pairs is salted, and so is a path that many pairs close.
    """
    known = _with_degrees(pairs, node_degrees(edges))
    a_lists = F.col("da") <= F.col("db")
    sides = known.select(
        "a",
        "b",
        F.when(a_lists, F.col("a")).otherwise(F.col("b")).alias("x"),
        F.when(a_lists, F.col("b")).otherwise(F.col("a")).alias("other"),
    )
    hops = both_ways(edges)
    sides = durable(sides, "sides")
    legs = durable(salted_join(sides, hops, ["x"]).select("a", "b", "other", "y"), "legs")
    closing = hops.select(F.col("x").alias("other"), "y")
    counted = (
        salted_join(legs, closing, ["other", "y"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    )
    return (
        pairs.select("a", "b")
        .join(counted, ["a", "b"], "left")
        .select("a", "b", F.coalesce("common", F.lit(0)).alias("common"))
    )
