"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into segments. By Cauchy-Schwarz, the inner product of two segments of length l is at
most l times the product of their means plus the product of their deviations (root of the summed squares
around the mean), so a few numbers per segment bound the score from above, which is the same as bounding
the distance from below. Coarse segments discard most rows, finer ones more, and what is left is scored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEVELS = (4, 16)  # segments, coarse to fine
QUERY_ROWS = 512
ROWS = 16_384
TOGETHER = 64  # queries whose bounds are held at once
SEEDS = 4  # rows scored first, in multiples of k: those of the highest coarse bounds
EXACT = 1 << 53  # floating-point products below this are exact integers
WHOLE = 1 << 62  # sums of 64-bit products below this do not wrap
RUN = 1 << 16  # equal queries listed at once


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(F.forall(vector, lambda x: finite(x.cast("double"))), F.lit(False))


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row: root of the length times the mean, and the deviation, of each segment."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    sizes = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / sizes
    spread = np.add.reduceat((x - np.repeat(mean, sizes, axis=1)) ** 2, edges[:-1], axis=1)
    return np.hstack([mean * np.sqrt(sizes), np.sqrt(spread)])


def best_of_block(
    queries: np.ndarray,
    query_ids: np.ndarray,
    rows: np.ndarray,
    ids: np.ndarray,
    copies: np.ndarray,
    k: int,
    levels: Sequence[int],
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per query its number, and the id, score and copies of its k best rows (ties go to smaller ids).

    Rows are distinct by id and vector and stand for ``copies`` each; the query itself is one of its own copies.
    """
    dim = rows.shape[1]
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(dim, 1)
    q, x = queries.astype(np.float64), rows.astype(np.float64)
    slack = 1e-9 * most + 1e-6
    stats = [(segment_statistics(q, s), segment_statistics(x, s)) for s in levels] if dim else []
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    own: list[list[int]] = [[] for _ in q]
    at = np.argsort(ids, kind="stable")
    for i, (low, high) in enumerate(zip(*(np.searchsorted(ids[at], query_ids, side=s) for s in ("left", "right")), strict=True)):
        own[i] = [j for j in at[low:high].tolist() if (rows[j] == queries[i]).all()]

    def scores(some: slice, at: np.ndarray) -> np.ndarray:
        if most < EXACT:
            return (q[some] @ x[at].T).astype(np.int64)
        if most < WHOLE:
            return queries[some] @ rows[at].T
        asked, held = queries[some].tolist(), rows[at].tolist()  # an OverflowError if a score needs more than 64 bits
        return np.array([[sum(map(mul, a, b)) for b in held] for a in asked], np.int64).reshape(-1, len(at))

    for begin in range(0, len(q) if len(x) else 0, TOGETHER):
        some = slice(begin, min(begin + TOGETHER, len(q)))
        bound = stats[0][0][some] @ stats[0][1].T if dim else np.zeros((some.stop - begin, len(x)))
        for i in range(some.start, some.stop):
            bound[i - begin, [j for j in own[i] if copies[j] == 1]] = -np.inf
        others = np.isfinite(bound)
        least = np.full(len(bound), -np.inf)  # k rows reach this at least
        if len(x) > k:
            seeds = np.argpartition(bound, -min(SEEDS * k, len(x)), axis=1)[:, -min(SEEDS * k, len(x)) :]
            reached = np.matmul(x[seeds], q[some][:, :, None])[:, :, 0]
            reached[~np.take_along_axis(others, seeds, axis=1)] = -np.inf
            least = np.partition(reached, -k, axis=1)[:, -k] - slack
        left = others & (bound >= least[:, None])
        for fine_q, fine_x in stats[1:]:
            at = np.flatnonzero(left.any(axis=0))
            left[:, at] &= fine_q[some] @ fine_x[at].T >= least[:, None]
        at = np.flatnonzero(left.any(axis=0))  # survivors of any of these queries are scored for all of them at once
        exact, left = scores(some, at), left[:, at]
        lowest = np.where(left, exact, np.iinfo(np.int64).min)
        cut = np.partition(lowest, -k, axis=1)[:, -k] if len(at) > k else np.full(len(left), np.iinfo(np.int64).min)
        for i in range(some.start, some.stop):
            mine = np.flatnonzero(left[i - begin] & (exact[i - begin] >= cut[i - begin]))
            score = exact[i - begin, mine]
            first = np.lexsort((ids[at[mine]], ~score))[:k]
            best = at[mine[first]]
            out.append((np.full(len(first), i), ids[best], score[first], copies[best] - np.isin(best, own[i])))
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def repeated(frame: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says, without that column; no list grows with it."""
    runs = F.sequence(F.lit(0), F.floor((F.col(times) - 1) / F.lit(RUN)))
    frame = frame.withColumn("run_", F.explode(runs))
    run = F.least(F.lit(RUN), F.col(times) - F.col("run_") * RUN)
    return frame.withColumn("run_", F.explode(F.sequence(F.lit(1).cast("long"), run))).drop("run_", times)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    levels: Sequence[int] = LEVELS,
    query_rows: int = QUERY_ROWS,
    rows_at_once: int = ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``vectors(vec_id, embedding)``.

    Queries are the rows for which ``is_query`` holds; each searches every row but itself. Scores are inner
    products of the components floor(scale * x) and must fit a long; ties go to the smaller vec_id. Rows with a
    null id, a null vector or a null or non-finite component take no part, and vectors meet those of their own
    length only. Every one of several rows with one id is a row of its own: a query finds its equals, and equal
    queries have equal results, one each. Rows equal in id and vector travel and are scored once, with their number.
    Blocks of queries meet blocks of rows, so a task holds one of each and no query sees more than k rows of a
    block in the result.
    """
    clean = (
        vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            quantised(F.col("embedding"), scale).alias("x"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
        .groupBy("vec_id", "x")
        .agg(F.count(F.lit(1)).alias("copies"), F.count_if("asks").alias("asking"))
    )
    counts = clean.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("asking") > 0).alias("q")).first()
    row_blocks = max(1, -(-counts.n // rows_at_once))
    query_blocks = max(1, -(-counts.q // query_rows))
    mine = F.xxhash64("vec_id")

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    cells = clean.select(
        "vec_id",
        "x",
        "copies",
        F.lit(0).cast("long").alias("asking"),
        F.pmod(mine, F.lit(row_blocks)).cast("int").alias("rows"),
        everywhere(query_blocks).alias("queries"),
    ).unionByName(
        clean.filter(F.col("asking") > 0).select(
            "vec_id",
            "x",
            "copies",
            "asking",
            F.pmod(mine, F.lit(query_blocks)).cast("int").alias("queries"),
            everywhere(row_blocks).alias("rows"),
        )
    )

    def search(table: pa.Table) -> pa.Table:
        asking, ids, copies = (table.column(c).to_numpy() for c in ("asking", "vec_id", "copies"))
        flat = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(len(ids), -1) if len(flat) else np.zeros((len(ids), 0), np.int64)
        asks = asking > 0
        queries, query_ids, times = x[asks], ids[asks], asking[asks]
        keys = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in queries]
        at, found, scores, count = best_of_block(queries, query_ids, x[~asks], ids[~asks], copies[~asks], k, levels)
        key = pa.array([keys[i] for i in at.tolist()], pa.binary())
        columns = [pa.array(query_ids[at]), key, pa.array(times[at]), pa.array(found), pa.array(scores), pa.array(count)]
        return pa.table(columns, names=["query_id", "query_key", "asking", "vec_id", "score", "copies"])

    schema = "query_id long, query_key binary, asking long, vec_id long, score long, copies long"
    best = cells.withColumn("length", F.size("x")).groupBy("queries", "rows", "length").applyInArrow(search, schema)
    # Vectors of one id are queries of their own; the row of n copies takes n ranks.
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id", "copies")
    before = F.sum(F.least("copies", F.lit(k))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = best.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < k)
    last = F.least(F.col("before") + F.col("copies"), F.lit(k))
    return repeated(
        ranked.select(
            "query_id",
            F.explode(F.sequence((F.col("before") + 1).cast("int"), last.cast("int"))).alias("rank"),
            "vec_id",
            "score",
            "asking",
        ),
        "asking",
    )
