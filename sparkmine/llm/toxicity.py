"""Toxicity scores by a factorization machine over hashed terms (Rendle 2010).

Terms are the words of a text and their first bytes, hashed into a fixed number of slots. Besides a weight,
each term has a small vector; the product of two terms' vectors is the weight of the two occurring
together, such as an insult with a group, which a linear model cannot see. The machine is fitted on a
bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.llm import texts
from sparkmine.llm.labelled import SAMPLE_ROWS, held_out, sigmoid, training_rows

SLOTS = 1 << 20  # of hashed terms
STEM_BYTES = 4
MAX_TERMS = 4_096  # terms that get weights: those that tell most about the label
LEAST_GAIN = 7.0  # of the log-likelihood; half the G statistic, so a term passes by chance once in 5,000
FACTORS = 4
STEPS = 150
RATE = 0.1
PENALTY = 2e-5
PENALTY_FACTORS = 5e-4
THRESHOLD = 0.7


def terms_of(raw: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and text number of the distinct terms of each text."""
    words, bounds = texts.word_hashes(raw, offsets, weights)
    stems, stem_bounds = stem_hashes(raw, offsets, weights)
    owner = np.concatenate([np.repeat(np.arange(len(offsets) - 1), np.diff(b)) for b in (bounds, stem_bounds)])
    slot = np.concatenate([words, stems * np.uint64(5) + np.uint64(1)]) >> np.uint64(64 - 20)
    both = np.unique((owner.astype(np.uint64) << np.uint64(20)) | slot)
    return (both & np.uint64(SLOTS - 1)).astype(np.int64), (both >> np.uint64(20)).astype(np.int64)


def stem_hashes(raw: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``STEM_BYTES`` bytes of words longer than that, and the texts' offsets."""
    value = weights[raw]
    padded = np.concatenate([value, np.zeros(STEM_BYTES + 1, np.uint64)])
    first = value != 0
    first[1:] &= value[:-1] == 0
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = value[begins] != 0
    at = np.flatnonzero(first)
    at = at[np.all([padded[at + i] != 0 for i in range(STEM_BYTES + 1)], axis=0)]
    ends = offsets[1:][np.searchsorted(offsets, at, side="right") - 1]
    at = at[at + STEM_BYTES < ends]
    stem = np.zeros(len(at), np.uint64)
    for i in range(STEM_BYTES):
        stem = texts.mixed(stem * np.uint64(3) + padded[at + i])
    return stem, np.searchsorted(at, offsets)


@dataclass
class Machine:
    """A fitted machine: ``index`` maps a slot to its row in the weights, -1 for none."""

    index: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, slot: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
        """Probability of label 1 for texts 0 to count - 1 with the given distinct terms."""
        row = self.index[slot]
        row, owner = row[row >= 0], owner[row >= 0]
        total = np.bincount(owner, self.linear[row], count) + self.bias
        for f in self.factors.T:
            value = f[row]
            total += (np.bincount(owner, value, count) ** 2 - np.bincount(owner, value**2, count)) / 2
        return sigmoid(total)


def informative(slot: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The slots whose occurrence depends most on the label, by the G statistic."""
    seen = np.bincount(slot, minlength=SLOTS).astype(float)
    ones = np.bincount(slot, labels[owner], SLOTS)
    n, p = len(labels), labels.sum()

    def part(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return observed * np.log(np.maximum(observed, 1e-12) / np.maximum(expected, 1e-12))

    gain = part(ones, seen * p / n) + part(seen - ones, seen * (n - p) / n)
    gain += part(p - ones, (n - seen) * p / n) + part(n - p - seen + ones, (n - seen) * (n - p) / n)
    best = np.argsort(-gain, kind="stable")[:MAX_TERMS]
    return np.sort(best[gain[best] > LEAST_GAIN])


def fit(slot: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> Machine:
    """Logistic loss with Adam on all rows at once; starts from fixed random vectors."""
    index = np.full(SLOTS, -1, np.int32)
    if not len(labels):
        return Machine(index, -35.0, np.zeros(0), np.zeros((0, FACTORS)))
    kept = informative(slot, owner, labels)
    index[kept] = np.arange(len(kept))
    row = index[slot]
    row, owner = row[row >= 0].astype(np.int64), owner[row >= 0]
    prior = (labels.sum() + 1) / (len(labels) + 2)
    random = np.random.default_rng(7)
    state = [
        np.array([np.log(prior / (1 - prior))]),
        np.zeros(len(kept)),
        random.normal(0, 0.01, (len(kept), FACTORS)),
    ]
    first, second = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]
    n = len(labels)
    for step in range(1, STEPS + 1):
        machine = Machine(index, float(state[0][0]), state[1], state[2])
        value = [f[row] for f in state[2].T]
        sums = [np.bincount(owner, v, n) for v in value]
        total = np.bincount(owner, state[1][row], n) + machine.bias
        for v, s in zip(value, sums, strict=True):
            total += (s**2 - np.bincount(owner, v**2, n)) / 2
        error = (sigmoid(total) - labels) / n
        pull = error[owner]
        slope = [
            np.array([error.sum()]),
            np.bincount(row, pull, len(kept)) + PENALTY * state[1],
            np.stack(
                [np.bincount(row, pull * (s[owner] - v), len(kept)) for v, s in zip(value, sums, strict=True)], axis=1
            )
            + PENALTY_FACTORS * state[2],
        ]
        for s, g, a, b in zip(state, slope, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            s -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return Machine(index, float(state[0][0]), state[1], state[2])


def sample_terms(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, owners and labels of bounded training rows; the terms are made in Spark."""
    weights = texts.byte_weights(texts.NON_WORD)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i, j in texts.slices(whole.column("text")):
                batch = whole.slice(i, j - i)
                slot, owner = terms_of(*texts.flat(batch.column("text")), weights)
                ends = np.searchsorted(owner, np.arange(len(batch) + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(ends), pa.array(slot.astype(np.int32)))
                names = ["doc_id", "label", "terms"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), found], names=names)

    schema = T.StructType([rows.schema["doc_id"], rows.schema["label"], T.StructField("terms", T.ArrayType(T.IntegerType()))])
    table = rows.mapInArrow(make, schema).toArrow()
    table = table.take(pa.array(np.argsort(table["doc_id"].to_numpy(), kind="stable")))
    terms = table["terms"].combine_chunks()
    counts = terms.value_lengths().to_numpy()
    slot = terms.flatten().to_numpy().astype(np.int64)
    return slot, np.repeat(np.arange(len(counts)), counts), table["label"].to_numpy().astype(float)


def train(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``bound`` labelled rows of ``documents(doc_id, text)`` and ``labels(doc_id, toxic)``."""
    return fit(*sample_terms(training_rows(documents, labels, "toxic", 3, 1, bound)))


def with_score(documents: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """Add the toxicity score of ``text`` as ``name``, replacing such a column; all else stays as it is."""
    weights = texts.byte_weights(texts.NON_WORD)
    parts = (machine.index, machine.bias, machine.linear, machine.factors)
    shared = documents.sparkSession.sparkContext.broadcast(parts)  # plain values: broadcasts name classes by their module
    kept = [c for c in documents.columns if c != name]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*shared.value)
        for whole in batches:
            for i, j in texts.slices(whole.column("text")):
                batch = whole.slice(i, j - i)
                slot, owner = terms_of(*texts.flat(batch.column("text")), weights)
                found = pa.array(machine.score(slot, owner, len(batch)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), found], names=[*kept, name])

    schema = T.StructType([*(documents.schema[c] for c in kept), T.StructField(name, T.DoubleType())])
    return documents.select(*kept).mapInArrow(score, schema)


def scored(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``documents``: doc_id, held_out, score, predicted.

    Null and empty texts have no terms and get the score of the bias alone; without any labelled row all
    scores are near 0. Repeated rows are scored one by one; other columns are ignored.
    """
    machine = train(documents, labels)
    rows = documents.select("doc_id", "text", held_out(F.col("doc_id"), 3, 1).alias("held_out"))
    return with_score(rows, machine).select("doc_id", "held_out", "score", predicted(F.col("score"), threshold))


def predicted(score: Column, threshold: float = THRESHOLD) -> Column:
    return (score >= threshold).cast("int").alias("predicted")
