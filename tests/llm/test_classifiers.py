"""Operators 8 and 10: held-out accuracy, what the models can express, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest

from sparkmine.llm import labelled, quality, toxicity
from tests.llm.frames import ODD_TEXTS, documents, sentence

GROUPS, INSULTS = ["gora", "mila", "tesk"], ["dolt", "oaf", "knave"]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="module")
def small():
    return "/root/testdata/sf0.01"


def accuracy(result, labels, name):
    truth = {r.doc_id: r[name] for r in labels.collect()}
    rows = [(r.score, truth[r.doc_id]) for r in result.collect() if r.held_out and r.doc_id in truth]
    ones = [s for s, y in rows if y]
    zeros = [s for s, y in rows if not y]
    area = np.mean([[(a > b) + (a == b) / 2 for b in zeros] for a in ones])
    false = sum(s >= 0.7 for s in zeros) / len(zeros)
    return area, false


def test_toxicity_on_held_out_rows(spark, small):
    labels = table(spark, small, "labels")
    result = toxicity.scored(table(spark, small, "documents"), labels)
    area, false = accuracy(result, labels, "toxic")
    assert area > 0.85 and false < 0.02


def test_quality_on_held_out_rows(spark, small):
    labels = table(spark, small, "labels")
    result = quality.scored(table(spark, small, "documents"), labels)
    area, false = accuracy(result, labels, "quality")
    assert area > 0.98 and false < 0.1


def recall(result, labels, name):
    truth = {r.doc_id: r[name] for r in labels.collect()}
    hits = [r.predicted for r in result.collect() if r.held_out and truth.get(r.doc_id)]
    return sum(hits) / len(hits)


def test_predictions_catch_most_held_out_toxic_rows(spark, small):
    labels = table(spark, small, "labels")
    assert recall(toxicity.scored(table(spark, small, "documents"), labels), labels, "toxic") > 0.6


def test_score_is_the_sum_over_pairs():
    """The machine's score against the plain double sum: bias, weights, and a product of vectors for each two terms."""
    rng = np.random.default_rng(8)
    index = np.full(toxicity.SLOTS, -1, np.int32)
    known = rng.permutation(200)[:50]
    index[known] = np.arange(50)
    machine = toxicity.Machine(index, -0.3, rng.normal(0, 1, 50), rng.normal(0, 0.5, (50, toxicity.FACTORS)))
    rows = [np.sort(rng.permutation(200)[: rng.integers(0, 40)]) for _ in range(30)] + [np.empty(0, np.int64)]
    slot = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    got = machine.score(slot, owner, len(rows))
    for row, score in zip(rows, got, strict=True):
        held = [int(index[t]) for t in row if index[t] >= 0]
        total = machine.bias + sum(machine.linear[i] for i in held)
        for n, i in enumerate(held):
            for j in held[n + 1 :]:
                total += float(machine.factors[i] @ machine.factors[j])
        assert score == pytest.approx(1 / (1 + math.exp(-total)))


def test_informative_terms_by_plain_counts():
    """The G statistic of each term from a table of counts, against the one that picks terms."""
    rng = random.Random(3)
    labels = np.array([float(i % 3 == 0) for i in range(300)])
    rows = [{t for t in range(40) if rng.random() < (0.1 + 0.4 * y if t < 10 else 0.2)} for y in labels]
    slot = np.array([t for r in rows for t in sorted(r)])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    def gain(term):
        total = 0.0
        for y in (0.0, 1.0):
            for said in (True, False):
                seen = sum((term in r) == said and label == y for r, label in zip(rows, labels, strict=True))
                both = sum((term in r) == said for r in rows) * sum(label == y for label in labels) / len(rows)
                total += seen * math.log(seen / both) if seen else 0.0
        return total

    expected = [t for t in range(40) if gain(t) > toxicity.LEAST_GAIN]
    assert toxicity.informative(slot, owner, labels).tolist() == expected and len(expected) >= 5


def test_rule_column_equals_plain_rules(spark, small):
    """The compiled column of operator 10 against its rules, one by one, on statistics made by :func:`quality.statistics`."""
    labels = table(spark, small, "labels")
    docs = table(spark, small, "documents")
    ensemble = quality.train(docs, labels)
    rows = quality.with_statistics(docs.select("doc_id", "text")).withColumn("score", ensemble.column()).collect()
    assert len(ensemble.rules) > 3
    for row in rows[:300]:
        total = ensemble.bias
        for rule, weight in zip(ensemble.rules, ensemble.weights, strict=True):
            fits = True
            for bound in rule:
                value = row["stat_" + quality.STATISTICS[bound.statistic]]
                fits &= value > bound.limit if bound.above else value <= bound.limit
            total += weight if fits else 0.0
        assert row.score == pytest.approx(1 / (1 + math.exp(-total)))


def test_machine_learns_pairs():
    """Neither an insult nor a group says anything by itself; both together do."""
    rng = random.Random(1)
    rows, y = [], []
    for _ in range(600):
        terms = {rng.randrange(100, 140) for _ in range(8)}
        a, b = rng.random() < 0.5, rng.random() < 0.5
        terms |= {1} if a else set()
        terms |= {2} if b else set()
        rows.append(sorted(terms))
        y.append(float(a and b) if rng.random() < 0.98 else 1.0)
    slot = np.array([t for r in rows for t in r])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    machine = toxicity.fit(slot, owner, np.array(y))
    p = machine.score(np.array([1, 2, 1, 2, 100]), np.array([0, 0, 1, 2, 3]), 4)
    assert p[0] > 0.9 and (p[1:] < 0.3).all()
    assert np.abs(machine.factors).max() > 0.1


def test_terms_against_plain_words():
    import pyarrow as pa

    from sparkmine.llm import texts

    weights = texts.byte_weights(texts.NON_WORD)
    said = ["abcd abcde ABCDE abcdefg", "", None, "abcd", "xabcde", "ab abcde"]
    slot, owner = toxicity.terms_of(*texts.flat(pa.array(said)), weights)
    assert np.bincount(owner, minlength=6).tolist() == [4, 0, 0, 1, 2, 3]  # words, and the stem of longer ones


def odd(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (3, "again"), (3, "again")]
    return rows, documents(spark, rows)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows_and_labels(spark, module, label):
    rows, frame = odd(spark)
    labels = spark.createDataFrame(
        [(0, 1), (1, 0), (2, None), (None, 1), (4, 0), (4, 1), (5, 0), (99, 1)], f"doc_id long, {label} int"
    ).selectExpr("*", "'x' as text", "'y' as score")
    for given in (labels, labels.limit(0)):
        result = module.scored(frame, given).collect()
        assert sorted(str(r.doc_id) for r in result) == sorted(str(i) for i, _ in rows)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in result)
        folds, fold = (3, 1) if label == "toxic" else (4, 2)
        for r in result:
            assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % folds == fold)
    assert module.scored(documents(spark, []), labels).collect() == []


def test_sample_is_bounded_and_repeatable(spark):
    frame = documents(spark, [(i, f"text {i}") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    first = labelled.training_rows(frame, labels, "toxic", 3, 1, 50)
    again = labelled.training_rows(frame.repartition(7), labels.repartition(5), "toxic", 3, 1, 50)
    ids = {r.doc_id for r in first.collect()}
    assert len(ids) == 50 and ids == {r.doc_id for r in again.collect()}
    assert all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)


def test_statistics_against_plain_python():
    import pyarrow as pa

    from sparkmine.llm import texts

    said = ["One two TWO two.\nOne  two\n\n#a# 12", "", None, "x", "same same\nsame same\nsame  same"]
    got = quality.statistics(*texts.flat(pa.array(said)))
    named = [dict(zip(quality.STATISTICS, row, strict=True)) for row in got]
    assert not got[1].any() and not got[2].any()
    first = named[0]
    assert first["words"] == pytest.approx(np.log1p(8))
    assert first["word_bytes"] == pytest.approx((3 + 3 + 3 + 4 + 3 + 3 + 3 + 2) / 8)
    assert first["distinct_words"] == pytest.approx(5 / 8)  # one, two, two., #a#, 12
    assert first["most_frequent"] == pytest.approx(3 / 8)
    assert first["repeated_words"] == pytest.approx(1 / 8)
    assert first["marked_words"] == pytest.approx(1 / 8)
    assert first["capitals"] == pytest.approx(5 / len(said[0]))
    assert first["line_words"] == pytest.approx(np.log1p(8 / 3))
    assert first["distinct_lines"] == 1
    assert named[4]["distinct_lines"] == pytest.approx(1 / 3)


def test_rules_as_columns(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, rng.randrange(1, 60)) + rng.choice(["", "!!!", " 123"])) for i in range(60)]
    frame = quality.with_statistics(documents(spark, rows)).toPandas().sort_values("doc_id")
    x = frame[["stat_" + s for s in quality.STATISTICS]].to_numpy()
    y = np.array([float("!" in t) for _, t in rows])
    ensemble = quality.fit(np.tile(x, (4, 1)), np.tile(y, 4))
    z = quality.rule_matrix(ensemble.rules, x) @ np.array(ensemble.weights) + ensemble.bias
    got = quality.with_statistics(documents(spark, rows)).select("doc_id", ensemble.column().alias("p")).collect()
    assert [r.p for r in sorted(got)] == pytest.approx((1 / (1 + np.exp(-z))).tolist())
    assert (np.round(1 / (1 + np.exp(-z))) == y).all()


def test_sample_has_one_row_per_id(spark):
    frame = documents(spark, [(i, f"text {j}") for i in range(40) for j in range(5)] + [(0, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    first = labelled.training_rows(frame, labels, "toxic", 3, 1, 20)
    again = labelled.training_rows(frame.repartition(7), labels, "toxic", 3, 1, 20)
    rows = sorted(map(tuple, first.collect()))
    assert len(rows) == len({r[0] for r in rows}) == 20 and rows == sorted(map(tuple, again.collect()))
