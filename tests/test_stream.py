import os
import random
from pathlib import Path

import pytest

from sparkmine.operators.reservoir import Run
from sparkmine.operators.storage import work_dir
from sparkmine.sources.text import edge_line_stream
from sparkmine.streaming.triangles import TriangleState, simple_arrivals, triangle_stream
from tests.test_edges import dense_graph, replay


def feed(spark, path, rows):
    spark.createDataFrame(rows, "u bigint, v bigint, pos bigint").write.mode("append").parquet(path)


def advance(spark, path, state, folder, dedupe=True):
    arrivals = spark.readStream.schema("u bigint, v bigint, pos bigint").parquet(path)
    writer = triangle_stream(arrivals, state, f"{folder}/checkpoint", dedupe)
    writer.trigger(availableNow=True).start().awaitTermination()


def test_batches_equal_replay(spark, tmp_path):
    edges = dense_graph()
    rng = random.Random(2)
    arrivals = []
    for e in edges:  # repeats and self-loops must not count
        arrivals.append(e)
        if rng.random() < 0.3:
            arrivals.append(tuple(reversed(rng.choice(arrivals))))
        if rng.random() < 0.1:
            arrivals.append((e[0], e[0]))
    rows = [(u, v, pos) for pos, (u, v) in enumerate(arrivals, 1)]
    run, path, folder = Run(40, 6), str(tmp_path / "in"), str(tmp_path / "state")
    state = TriangleState(spark, folder, run)
    cuts = [0, 20, 90, len(rows)]
    for start, end in zip(cuts, cuts[1:]):
        part = rows[start:end]
        rng.shuffle(part)
        feed(spark, path, part)
        advance(spark, path, state, folder)
        after = state.latest().first()
        assert after.estimate == pytest.approx(replay(edges, run)[2][after.edges - 1])
    total, places, _ = replay(edges, run)
    last = state.latest().first()
    assert (last.edges, last.estimate) == (len(edges), pytest.approx(total))
    slots = spark.read.parquet(state._slots(state.batches()[-1]))
    assert {r.slot: (r.a, r.b) for r in slots.collect()} == {
        s: tuple(sorted(e)) for s, e in places.items()
    }


def test_a_batch_can_run_again(spark, tmp_path):
    edges = [(min(e), max(e), pos) for pos, e in enumerate(dense_graph(), 1)]
    schema = "a bigint, b bigint, pos bigint"
    state = TriangleState(spark, str(tmp_path), Run(30, 6))
    state.prepare()
    state.prepare()
    state.update(spark.createDataFrame(edges[:70], schema), 0)
    state.update(spark.createDataFrame(edges[70:], schema), 1)
    before = state.latest().first()
    state.update(spark.createDataFrame(edges[70:], schema), 1)
    assert state.latest().first() == before
    state.update(spark.createDataFrame(edges[:5], schema), 2)  # nothing new
    assert state.latest().first()[:3] == before[:3]
    assert before.estimate == pytest.approx(replay([e[:2] for e in edges], Run(30, 6))[0])


def files_below(folder, but):
    return [p for p in folder.rglob("*") if p.is_file() and but not in p.parts]


def test_a_simple_stream_keeps_no_more_with_every_batch(spark, tmp_path):
    """Without repeats nothing is remembered but the reservoir: as many files after 12 batches as after 3."""
    edges = dense_graph(m=120)
    path, folder = str(tmp_path / "in"), tmp_path / "state"
    state = TriangleState(spark, str(folder), Run(25, 6))
    shared = Path(work_dir(spark)) / "sparkmine"
    kept = []
    for part in range(12):
        feed(spark, path, [(*edges[pos - 1], pos) for pos in range(part * 10 + 1, part * 10 + 11)])
        advance(spark, path, state, str(folder), dedupe=False)
        if part in (2, 11):
            kept.append((len(files_below(folder, "checkpoint")), len(list(shared.glob("*/arrivals-*")))))
        assert state.batches() == [part - 1, part]
    assert kept[0] == kept[1]
    last = state.latest().first()
    assert (last.edges, last.estimate) == (120, pytest.approx(replay(edges, Run(25, 6))[0]))
    arrivals = spark.readStream.schema("u bigint, v bigint, pos bigint").parquet(path)
    plan = simple_arrivals(arrivals)._jdf.queryExecution().logical().toString()
    assert "Aggregate" not in plan and "Deduplicate" not in plan


def test_lines_are_numbered_as_they_come(spark, tmp_path):
    """A stream of text files without positions, stopped and resumed between batches, equals the replay of all lines."""
    edges = dense_graph()
    rng = random.Random(5)
    arrivals = []
    for e in edges:
        arrivals.append(e)
        if rng.random() < 0.4:
            arrivals.append(tuple(reversed(rng.choice(arrivals))))  # a repeat, perhaps of an earlier batch
        if rng.random() < 0.1:
            arrivals.append((e[0], e[0]))
    run, path, folder = Run(40, 6), tmp_path / "in", str(tmp_path / "state")
    path.mkdir()
    state = TriangleState(spark, folder, run)
    cuts = [0, 25, 25, 100, len(arrivals)]
    for number, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
        lines = [f"{u}\t{v}" for u, v in arrivals[start:end]]
        half = len(lines) // 2
        for name, part in (("a", lines[:half]), ("b", lines[half:])):  # two files of one batch, in order of name
            (path / f"{9 - number}{name}.txt").write_text("\n".join(["# edges", *part, ""]))
            os.utime(path / f"{9 - number}{name}.txt", (1_000_000 + number, 1_000_000 + number))
        stream = edge_line_stream(spark, str(path))
        triangle_stream(stream, state, f"{folder}/checkpoint", True).trigger(availableNow=True).start().awaitTermination()
        after = state.latest().first()
        assert after.last_pos == end
        if after.edges:
            assert after.estimate == pytest.approx(replay(edges, run)[2][after.edges - 1])
    last = state.latest().first()
    assert (last.edges, last.estimate) == (len(edges), pytest.approx(replay(edges, run)[0]))


def test_a_batch_of_lines_can_run_again(spark, tmp_path):
    edges = dense_graph()
    schema = "u bigint, v bigint, file_time timestamp, file_path string, block_start bigint"
    state = TriangleState(spark, str(tmp_path), Run(30, 6))
    state.prepare()

    def rows(some, name):
        return spark.createDataFrame([(u, v, None, name, 0) for u, v in some], schema).coalesce(1)

    state.update_lines(rows(edges[:70], "a"), 0, dedupe=True)
    state.update_lines(rows(edges[60:], "b"), 1, dedupe=True)
    before = state.latest().first()
    state.update_lines(rows(edges[60:], "b"), 1, dedupe=True)
    assert state.latest().first() == before
    assert (before.edges, before.estimate) == (len(edges), pytest.approx(replay(edges, Run(30, 6))[0]))
