"""Exact triangle count by colours of nodes (Suri and Vassilvitskii 2011).

Nodes are dealt over p colours by hash. An edge whose ends have colours x and y goes to the p places named by x, y and any
third colour, so all edges of a triangle meet in the place named by the colours of its nodes, and a place holds about
6 / p**2 of the edges, whatever a hub's degree. In a place edges are directed from the end of lower degree, which leaves
no node with more than sqrt(2 * edges) ahead, and each path of two edges is looked up among the edges.

A triangle of one colour x is also met in the places (x, x, y); those p - 1 are taken off again.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACE_EDGES = 1_000_000  # edges in one place, about
PATHS = 1 << 18  # of two edges, looked up at once


def colours_for(edges: int, place_edges: int = PLACE_EDGES) -> int:
    """As few colours as leave about ``place_edges`` edges in a place."""
    return max(1, math.ceil(math.sqrt(6 * edges / place_edges)))


def count_triangles(a: np.ndarray, b: np.ndarray) -> int:
    """Triangles of the distinct undirected edges a-b between nodes numbered from 0."""
    if not len(a):
        return 0
    nodes = int(max(a.max(), b.max())) + 1
    degree = np.bincount(a, minlength=nodes) + np.bincount(b, minlength=nodes)
    rank = np.empty(nodes, np.int64)
    rank[np.argsort(degree, kind="stable")] = np.arange(nodes)
    low, high = np.minimum(rank[a], rank[b]), np.maximum(rank[a], rank[b])
    keys = low * nodes + high
    keys.sort()
    np.floor_divide(keys, nodes, out=low)
    np.remainder(keys, nodes, out=high)
    begin = np.searchsorted(low, np.arange(nodes + 1))
    ahead = begin[high + 1] - begin[high]  # paths low - high - further
    ends = np.cumsum(ahead)
    total, i = 0, 0
    while i < len(keys):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PATHS, side="right")))
        counts = ahead[i:j]
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        wanted = np.repeat(low[i:j], counts) * nodes + high[np.repeat(begin[high[i:j]], counts) + step]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        total += int(np.count_nonzero(keys[at] == wanted))
        i = j
    return total


def triangles_by_colour(edges: DataFrame, colours: int) -> DataFrame:
    """One row ``triangles`` for ``edges(a, b)``, distinct and without self-loops."""
    if colours < 1:
        raise ValueError("there must be a colour")
    x, y = (F.pmod(F.xxhash64(c), F.lit(colours)).cast("int") for c in ("a", "b"))
    names = F.transform(F.sequence(F.lit(0), F.lit(colours - 1)), lambda z: F.array_sort(F.array(x, y, z)))
    dealt = edges.select("a", "b", F.explode(names).alias("place"))
    dealt = dealt.select("a", "b", *[F.col("place")[i].alias(c) for i, c in enumerate("xyz")])

    def count(table: pa.Table) -> pa.Table:
        first, second = (table.column(c).combine_chunks() for c in "ab")
        names = pa.concat_arrays([first, second]).dictionary_encode()
        number = names.indices.to_numpy()
        found = count_triangles(number[: len(first)].astype(np.int64), number[len(first) :].astype(np.int64))
        one = table.column("x")[0].as_py() == table.column("z")[0].as_py()
        return pa.table({"found": pa.array([found * (2 - colours) if one else found], pa.int64())})

    counted = dealt.groupBy("x", "y", "z").applyInArrow(count, "found bigint")
    return counted.agg(F.coalesce(F.sum("found"), F.lit(0)).alias("triangles"))
