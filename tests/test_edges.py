import hashlib
import itertools
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.functions.draws import uniform
from sparkmine.operators import edges as ops
from sparkmine.operators import skew, storage, triangles
from sparkmine.operators.colours import colours_for, count_triangles
from sparkmine.operators.order import first_n, number_rows, running_total, shuffled_order
from sparkmine.operators.reservoir import Run, lifetimes, replacement_log, sample_at
from sparkmine.operators.storage import durable
from sparkmine.operators.triangles import heavy_paths
from sparkmine.plans.triest import TriangleStream, size_by_ratio
from tests import brute

# two triangles with an edge in common, a bridge, and a third triangle
BRIDGED = [(10, 20), (20, 30), (10, 30), (20, 40), (30, 40), (40, 50), (50, 60), (60, 70), (50, 70)]


def dense_graph(n=24, m=130, seed=8):
    rng = random.Random(seed)
    return rng.sample(list(itertools.combinations(range(n), 2)), m)


def stream(spark, edges):
    rows = [(t, min(e), max(e)) for t, e in enumerate(edges, 1)]
    return durable(spark.createDataFrame(rows, "t bigint, a bigint, b bigint"))


def draw(seed, mark):
    def value(t):
        return int(hashlib.md5(f"{seed}{mark}:{t}".encode()).hexdigest()[:13], 16) / 2**52

    return value


def replay(edges, run):
    return brute.estimate(edges, run.size, draw(run.seed, "a"), draw(run.seed, "s"))


# order


def test_number_rows(spark):
    values = list(range(1000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v // 10, v) for v in values], "x int, y int").repartition(7)
    rows = number_rows(df, ["x", "y"], "n").collect()
    assert sorted((r.n, r.y) for r in rows) == [(v + 1, v) for v in range(1000)]
    assert first_n(number_rows(df, ["x", "y"], "n"), 3, "n").count() == 3
    assert number_rows(df.limit(0), ["x", "y"], "n").count() == 0


def test_shuffled_order_is_repeatable(spark):
    df = spark.range(50)
    one = [r.id for r in shuffled_order(df, "id", 1).orderBy("shuffle_key").collect()]
    again = [
        r.id for r in shuffled_order(df.repartition(5), "id", 1).orderBy("shuffle_key").collect()
    ]
    other = [r.id for r in shuffled_order(df, "id", 2).orderBy("shuffle_key").collect()]
    assert one == again != other
    assert sorted(one) == list(range(50))


@pytest.mark.parametrize("n", [1, 2, 10, 100])
def test_running_total(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").alias("i"), (F.col("id") * 2).alias("v"))
    rows = running_total(df, "i", "v", "s", n).collect()
    assert {r.i: r.s for r in rows} == {i: i * (i + 1) for i in range(1, n + 1)}


# edges


def test_canonical_edges(spark):
    rows = [(1, 5, 5), (2, 7, 3), (3, 3, 7), (4, 3, 7), (5, 1, 2)]
    df = spark.createDataFrame(rows, "pos int, u bigint, v bigint")
    clean = ops.canonical_edges(df, "u", "v", ["pos"])
    assert sorted((r.a, r.b, r.first.pos) for r in clean.collect()) == [(1, 2, 5), (3, 7, 2)]
    assert sorted(tuple(r) for r in ops.edge_positions(clean).collect()) == [(1, 3, 7), (2, 1, 2)]


def test_successive(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "ts int, who string")
    got = sorted((r.n, r.u, r.v) for r in ops.successive(df, "who", ["ts"]).collect())
    assert got == [(1, "a", "b"), (2, "b", "c")]


@pytest.mark.parametrize("salt", [2, 1_000_000])
def test_neighbours_of_a_hub(spark, monkeypatch, salt):
    """Node 0 knows all others, which form a ring; every pair is asked for, and two strangers."""
    monkeypatch.setattr("sparkmine.operators.skew.SALT_ROWS", salt)
    ring = range(1, 13)
    graph = {(0, i) for i in ring} | {(i, i % 12 + 1) for i in ring}
    near = {i: {b if a == i else a for a, b in graph if i in (a, b)} for i in range(13)}
    edges = stream(spark, sorted(graph))
    asked = [*itertools.combinations(range(13), 2), (0, 99), (98, 99)]
    pairs = durable(spark.createDataFrame(asked, "a bigint, b bigint"))
    found = {(r.a, r.b): r.common for r in ops.common_neighbors(edges, pairs).collect()}
    assert found == {(a, b): len(near.get(a, set()) & near.get(b, set())) for a, b in asked}
    assert {r.node: r.degree for r in ops.node_degrees(edges).collect()} == {i: len(n) for i, n in near.items()}
    nodes = spark.createDataFrame([(0,), (5,), (5,), (99,)], "node bigint")
    listed = sorted((r.node, r.neighbor) for r in ops.neighbors_of(edges, nodes).collect())
    assert listed == sorted((i, j) for i in (0, 5) for j in near[i])


@pytest.mark.parametrize(
    "edges",
    [BRIDGED, dense_graph(), [(1, 2)], [(0, i) for i in range(1, 40)] + [(1, 2), (2, 3), (1, 3)]],
    ids=["bridged", "dense", "single", "hub"],
)
def test_exact_triangles(spark, edges):
    assert ops.exact_triangles(stream(spark, edges)).first().triangles == brute.triangles(edges)


@pytest.mark.parametrize("colours", [1, 2, 3, 7])
def test_exact_triangles_by_colours(spark, colours):
    edges = dense_graph() + [(100, i) for i in range(24)] + [(200, 201)]
    assert ops.exact_triangles(stream(spark, edges), colours).first().triangles == brute.triangles(edges)


def test_a_place_is_counted_in_little_memory():
    """The paths looked up at once are few beside a place's edges: 1.2 million paths here, of 50,000 edges."""
    rng = np.random.default_rng(6)
    keys = np.unique(rng.integers(0, 2_000 * 2_000, 52_000))
    a, b = keys // 2_000, keys % 2_000
    a, b = a[a < b], b[a < b]
    expected = np.zeros((2_000, 2_000), np.float32)
    expected[a, b] = expected[b, a] = 1
    tracemalloc.start()
    found = count_triangles(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == round(float(((expected @ expected) * expected).sum(dtype=np.float64)) / 6)
    assert peak < 20 << 20


def test_only_paths_from_busy_nodes_are_counted(spark, monkeypatch):
    monkeypatch.setattr(skew, "SALT_ROWS", 3)
    rows = [(1, t, "hub", "y") for t in range(6)] + [(1, t, "hub", f"y{t}") for t in range(9)] + [(1, t, f"n{t}", "y") for t in range(9)]
    legs = storage.durable(spark.createDataFrame(rows, "run int, t bigint, other string, y string"))
    assert [r[:] for r in heavy_paths(legs).collect()] == [(1, "hub", "y", 6)]


def test_nodes_may_be_names(spark):
    named = [(f"n{a}", f"n{b}") for a, b in dense_graph()]
    edges = spark.createDataFrame([(min(e), max(e)) for e in named], "a string, b string")
    assert ops.exact_triangles(durable(edges), 3).first().triangles == brute.triangles(dense_graph())


def test_a_hub_is_spread_over_places(spark):
    """A node that is in every third edge: no place has much more than its share, and no list travels with an edge."""
    rng = random.Random(6)
    edges = {(0, i) for i in range(1, 1501)} | {tuple(sorted(rng.sample(range(1, 1501), 2))) for _ in range(3000)}
    frame = stream(spark, sorted(edges))
    colours = colours_for(len(edges), place_edges=200)
    found = ops.exact_triangles(frame, colours)
    assert found.first().triangles == brute.triangles(sorted(edges))
    plan = found._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "array<" not in plan.split("Exchange")[1]
    places = Counter()
    colour = {r.n: r.c for r in spark.range(1501).selectExpr("id n", f"pmod(xxhash64(id), {colours}) c").collect()}
    for a, b in edges:
        for third in range(colours):
            places[tuple(sorted((colour[a], colour[b], third)))] += 1
    assert max(places.values()) <= 1200 and sum(places.values()) == colours * len(edges)


# reservoir


def test_draws(spark):
    got = spark.range(100).select(uniform(F.lit("7a"), F.col("id"))).collect()
    assert [r[0] for r in got] == [draw(7, "a")(i) for i in range(100)]


@pytest.mark.parametrize("size", [2, 3, 10, 50])
def test_reservoir_equals_replay(spark, size):
    edges = dense_graph()
    run = Run(size, 9)
    lives = lifetimes(stream(spark, edges), [run], ["a", "b"])
    for upto in (1, size, 60, len(edges)):
        _, places, _ = replay(edges[:upto], run)
        got = {r.slot: (r.a, r.b) for r in sample_at(lives, upto).collect()}
        assert got == {s: tuple(sorted(e)) for s, e in places.items()}
    assert sample_at(lives).count() == min(size, len(edges))


def test_replacement_log(spark):
    """Readings with a time and a value: each leaves where it came in, and what is logged rebuilds the sample."""
    rng = random.Random(21)
    readings = [(t, f"s{rng.randrange(5)}", rng.random()) for t in range(1, 400)]
    rows = spark.createDataFrame(readings, "t bigint, sensor string, value double")
    lives = durable(lifetimes(rows, [Run(17, 3)], ["sensor", "value"]))
    held = {}
    for row in sorted(replacement_log(lives, ["sensor", "value"]).collect(), key=lambda r: r.t):
        assert readings[row.t - 1][1:] == (row.sensor, row.value)
        assert held.get(row.slot) == (None if row.old_sensor is None else (row.old_sensor, row.old_value))
        held[row.slot] = (row.sensor, row.value)
    assert held == {r.slot: (r.sensor, r.value) for r in sample_at(lives).collect()}
    assert sorted(held) == list(range(17))


def test_inclusion_is_uniform(spark):
    rows = spark.range(1, 101).select(F.col("id").alias("t"))
    lives = lifetimes(rows, [Run(10, seed) for seed in range(400)], [])
    kept = sample_at(lives)
    assert kept.count() == 4000
    share = {r.early: r["count"] for r in kept.groupBy((F.col("t_in") <= 50).alias("early")).count().collect()}
    assert abs(share[True] - 2000) < 150  # about five standard deviations


def test_small_reservoirs_are_refused():
    with pytest.raises(ValueError):
        Run(1)


# triangles


@pytest.mark.parametrize("size", [2, 10, 40, 129, 130, 500])
def test_estimate_equals_replay(spark, size):
    edges = dense_graph()
    run = Run(size, 4)
    total, _, gains = replay(edges, run)
    job = TriangleStream(stream(spark, edges), [run])
    assert job.estimates.first().estimate == pytest.approx(total)
    if size >= len(edges) - 1:  # the last edge arrives before it could replace another
        assert total == brute.triangles(edges)
    history = {r.t: r.estimate for r in job.history(25).collect()}
    assert history == {t: int(gains[t - 1]) for t in range(25, 131, 25)}


def test_large_samples_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("sparkmine.operators.triangles.BROADCAST_BYTES", -2)
    monkeypatch.setattr("sparkmine.operators.skew.SALT_ROWS", 3)
    edges = dense_graph()
    job = TriangleStream(stream(spark, edges), [Run(30, 2), Run(60, 3)])
    got = {r.size: r.estimate for r in job.estimates.collect()}
    assert got == {
        30: pytest.approx(replay(edges, Run(30, 2))[0]),
        60: pytest.approx(replay(edges, Run(60, 3))[0]),
    }


def test_estimate_is_unbiased(spark):
    edges = dense_graph()
    true = brute.triangles(edges)
    runs = [Run(40, seed) for seed in range(200)]
    got = [r.estimate for r in TriangleStream(stream(spark, edges), runs).estimates.collect()]
    mean = sum(got) / len(got)
    error = (sum((g - mean) ** 2 for g in got) / (len(got) - 1) / len(got)) ** 0.5
    assert abs(mean - true) < 3 * error


def test_errors(spark):
    job = TriangleStream(stream(spark, BRIDGED), [Run(10)])
    row = job.errors().first()
    assert (row.triangles, row.abs_error, row.rel_error, row.band) == (3, 0.0, 0.0, "excellent")
    flat = TriangleStream(stream(spark, [(1, 2), (2, 3)]), [Run(10)]).errors().first()
    assert (flat.estimate, flat.rel_error, flat.band) == (0.0, None, None)


def test_bands(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.19,), (0.2,), (None,)], "e double")
    got = [r[0] for r in df.select(triangles.accuracy_band(F.col("e"))).collect()]
    assert got == ["excellent", "good", "good", "high variance", None]


def test_size_by_ratio():
    assert size_by_ratio(88234, 0.10) == 8823


def test_plans(spark):
    job = TriangleStream(stream(spark, dense_graph()), [Run(30)])
    for df in (job.estimates, job.history(10), job.errors(), ops.exact_triangles(job.edges)):
        plan = df._jdf.queryExecution().toString()
        for name in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert name not in plan
