"""Operator 4 against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.llm import topk


def brute(rows, k=20):
    clean = []
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        clean.append((vec_id, [math.floor(64 * x) for x in v]))
    out = []
    for n, (q, a) in enumerate(clean):
        if q % 20:
            continue
        others = [(b, i) for m, (i, b) in enumerate(clean) if m != n and len(a) == len(b)]
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for b, i in others)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, dtype="float", **options):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{dtype}>")
    frame = frame.withColumns({c: F.lit("x") for c in ("label", "x", "score", "rank", "queries", "asks")})
    result = topk.top_k(frame, F.col("vec_id") % 20 == 0, **options)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, result.collect()))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 24)]) for i in range(300)]
    out += [(1000 + i, [0.25] * 24) for i in range(60)]  # ties
    return out


@pytest.mark.parametrize("options", [{}, {"query_rows": 5, "rows_at_once": 40}, {"levels": (1, 3, 24)}])
def test_equals_brute_force(spark, rows, options):
    assert found(spark, rows, **options) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [math.nan, 1.0]), (80, [math.inf, 1.0]), (None, [1.0, 1.0])]
    rows += [(100, []), (120, []), (3, [5.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (7, [-1.0, -0.001]), (140, [0.5, 0.5, 0.5])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


@pytest.mark.parametrize("options", [{}, {"query_rows": 2, "rows_at_once": 7}])
def test_every_row_counts(spark, options, monkeypatch):
    monkeypatch.setattr(topk, "RUN", 3)
    rng = np.random.default_rng(7)
    base = [[float(np.float32(x)) for x in rng.normal(0, 0.3, 8)] for _ in range(6)]
    rows = [(i, base[i % 6]) for i in range(30)]
    rows += [(20, base[2])] * 7  # equal queries
    rows += [(40, base[i]) for i in range(6)]  # one id, several vectors
    rows += [(3, [0.9] * 8)] * 25  # more copies than ranks
    rows += [(60, [0.9] * 8), (60, [0.9] * 8), (80, [])]
    assert found(spark, rows, **options) == brute(rows)


def test_scores_beyond_64_bit_products(spark):
    large = float(1 << 55)
    rows = [(0, [large, 1.0, 1.0]), (1, [2.0, 3.0, 0.0]), (2, [-2.0, 0.0, 0.5]), (3, [0.0, 5.0, 5.0])]
    with pytest.raises(Exception, match="Overflow|too large|too big"):
        found(spark, rows, "double")
    rows[0] = (0, [float(1 << 46), 1.0, 1.0])
    rows += [(5, [-float(1 << 3), 0.0, 0.0])]
    assert found(spark, rows, "double") == brute(rows)


def test_scores_beyond_exact_floats(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(-(1 << 21), 1 << 21, 40)]) for i in range(60)]
    assert found(spark, rows, "double") == brute(rows)


def test_bounds_are_above_scores():
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(50, 30)), rng.normal(size=(40, 30))
    before = None
    for segments in (1, 4, 16, 30):
        bound = topk.segment_statistics(x, segments) @ topk.segment_statistics(y, segments).T
        assert (bound >= x @ y.T - 1e-9).all()
        assert before is None or bound.mean() <= before
        before = bound.mean()
