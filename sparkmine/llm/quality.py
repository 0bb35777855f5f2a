"""Quality scores by a sparse rule ensemble (RuleFit, Friedman and Popescu 2008).

Small boosted trees over statistics of a text propose rules: each path from a root is a conjunction of
bounds on statistics. Logistic regression with a lasso penalty keeps few of them, and these become one Spark
column expression. Trees and weights are fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmine.llm import texts
from sparkmine.llm.labelled import SAMPLE_ROWS, held_out, sigmoid, training_rows

STATISTICS = (
    "words",  # logarithm of their number plus 1
    "word_bytes",  # mean length
    "capitals",  # shares of the bytes
    "digits",
    "marks",
    "sentence_ends",
    "beyond_ascii",
    "short_words",  # shares of the words
    "repeated_words",
    "distinct_words",
    "most_frequent",
    "marked_words",
    "line_words",  # logarithm of words per line
    "distinct_lines",  # share of the lines
)
TREES = 40
DEPTH = 3
BINS = 32
LEAST_ROWS = 10  # training rows on each side of a cut
SHRINKAGE = 0.3
LASSO = 1e-3
STEPS = 400
THRESHOLD = 0.7


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` per text; all 0 for a text without words."""
    n = len(offsets) - 1
    weights = texts.byte_weights(texts.SPACES)
    words, bounds = texts.word_hashes(raw, offsets, weights)
    counts = np.diff(bounds)
    sizes = np.maximum(np.diff(offsets), 1)
    per_word = np.maximum(counts, 1)
    owner = np.repeat(np.arange(n), counts)
    kinds = np.zeros(256, np.uint8)
    for code in range(0x21, 0x7F):
        c = chr(code)
        kinds[code] = 1 if c.isupper() else 2 if c.isdigit() else 0 if c.islower() else 4 if c in ".,?;:" else 3
    kinds[0x80:] = 5
    kinds[list(texts.SPACES)] = 6
    kinds[0x0A] = 7
    kind = kinds[raw]
    text_of = np.repeat(np.arange(n), np.diff(offsets))
    table = np.bincount(text_of * 8 + kind, minlength=8 * n).reshape(n, 8).astype(float) if n else np.zeros((0, 8))
    blank = kind >= 6
    starts = ~blank
    starts[1:] &= blank[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    starts[begins] = ~blank[begins]
    at = np.flatnonzero(starts)
    inked = np.concatenate([[0], np.cumsum(~blank)])
    marked = np.concatenate([[0], np.cumsum(kind == 3)])
    after = np.append(at[1:], len(raw))
    length = inked[after] - inked[at]
    with_mark = marked[after] - marked[at] > 0

    def share(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, n) / per_word

    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((words, owner))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    runs = np.diff(np.append(np.flatnonzero(fresh), len(words)))
    run_owner = owner[order][fresh]
    most = np.zeros(n)
    np.maximum.at(most, run_owner, runs)
    distinct = np.bincount(run_owner, minlength=n)
    line = line_numbers(raw, offsets, at)
    line_key = texts.mixed(words + np.uint64(1))
    line_start = np.ones(len(words), bool)
    line_start[1:] = (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(line_start)
    place = np.arange(len(words)) - np.repeat(first, np.diff(np.append(first, len(words))))
    line_hash = np.add.reduceat(line_key * (place * 2 + 1).astype(np.uint64), first) if len(first) else line_key[:0]
    line_owner = owner[first]
    lines = np.bincount(line_owner, minlength=n)
    line_order = np.lexsort((line_hash, line_owner))
    new_line = np.ones(len(first), bool)
    new_line[1:] = (line_hash[line_order][1:] != line_hash[line_order][:-1]) | (
        line_owner[line_order][1:] != line_owner[line_order][:-1]
    )
    distinct_lines = np.bincount(line_owner[line_order][new_line], minlength=n)
    some = counts > 0
    columns = [
        np.log1p(counts),
        share(length),
        *(table[:, i] / sizes for i in (1, 2, 3, 4, 5)),
        share(length <= 3),
        share(same),
        distinct / per_word,
        most / per_word,
        share(with_mark),
        np.log1p(counts / np.maximum(lines, 1)),
        distinct_lines / np.maximum(lines, 1),
    ]
    return np.stack(columns, axis=1) * some[:, None]


def line_numbers(raw: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many line ends come before each position."""
    return np.searchsorted(np.flatnonzero(raw == 0x0A), at)


def with_statistics(documents: DataFrame, prefix: str = "stat_") -> DataFrame:
    """Add the statistics of ``text`` as ``prefix`` columns, replacing such columns."""
    added = [prefix + s for s in STATISTICS]
    kept = [c for c in documents.columns if c not in added]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i, j in texts.slices(whole.column("text")):
                batch = whole.slice(i, j - i)
                found = statistics(*texts.flat(batch.column("text")))
                columns = [*(batch.column(c) for c in kept), *(pa.array(c) for c in found.T)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    schema = T.StructType([*(documents.schema[c] for c in kept), *(T.StructField(a, T.DoubleType()) for a in added)])
    return documents.select(*kept).mapInArrow(measure, schema)


@dataclass(frozen=True)
class Bound:
    """A statistic at most ``limit``, or above it."""

    statistic: int
    limit: float
    above: bool

    def holds(self, x: np.ndarray) -> np.ndarray:
        over = x[:, self.statistic] > self.limit
        return over if self.above else ~over

    def column(self, prefix: str) -> Column:
        value = F.col(prefix + STATISTICS[self.statistic])
        return value > self.limit if self.above else value <= self.limit


Rule = tuple[Bound, ...]


def rule_matrix(rules: Sequence[Rule], x: np.ndarray) -> np.ndarray:
    return np.stack([reduce(np.logical_and, [b.holds(x) for b in r]) for r in rules], axis=1).astype(float)


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]


def _grow(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray, path: Rule, out: list):
    """Append (path, rows, value) for the leaves and (path, None, None) for the inner nodes below ``path``."""
    best = (1e-6, None, None)
    g, h = slope[rows].sum(), curve[rows].sum()
    if len(path) < DEPTH:
        for j, cut in enumerate(cuts):
            if not len(cut):
                continue
            place = np.searchsorted(cut, x[rows, j])  # 0 for at most the first cut
            left_g = np.cumsum(np.bincount(place, slope[rows], len(cut) + 1))[:-1]
            left_h = np.cumsum(np.bincount(place, curve[rows], len(cut) + 1))[:-1]
            left_n = np.cumsum(np.bincount(place, minlength=len(cut) + 1))[:-1]
            gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
            gain[(left_n < LEAST_ROWS) | (len(rows) - left_n < LEAST_ROWS)] = 0
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (gain[i], j, float(cut[i]))
    if best[1] is None:
        out.append((path, rows, -g / (h + 1)))
        return
    if path:
        out.append((path, None, None))
    for above in (False, True):
        bound = Bound(best[1], best[2], above)
        _grow(x, slope, curve, cuts, rows[bound.holds(x[rows])], (*path, bound), out)


def propose(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """All distinct paths of boosted trees, one of each two complementary single bounds left out."""
    cuts, rules = _cuts(x), {}
    margin = np.zeros(len(y))
    for _ in range(TREES):
        p = sigmoid(margin)
        nodes: list = []
        _grow(x, p - y, np.maximum(p * (1 - p), 1e-6), cuts, np.arange(len(y)), (), nodes)
        for path, rows, value in nodes:
            if rows is not None:
                margin[rows] += SHRINKAGE * value
            if path and not (len(path) == 1 and not path[0].above):
                rules[path] = None
    return list(rules)


@dataclass(frozen=True)
class Ensemble:
    bias: float
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]

    def column(self, prefix: str = "stat_") -> Column:
        """The score as one expression over the statistics."""
        total: Column = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            fits = reduce(Column.__and__, [b.column(prefix) for b in rule])
            total = total + F.when(fits, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """Lasso logistic regression over the proposed rules, by accelerated proximal gradient steps."""
    if not len(y):
        return Ensemble(-35.0, (), ())
    prior = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(prior / (1 - prior)))
    rules = propose(x, y)
    if not rules:
        return Ensemble(start, (), ())
    z = rule_matrix(rules, x)
    mean, n = z.mean(axis=0), len(y)
    centred = z - mean
    step = 4 * n / max(np.linalg.norm(centred, 2) ** 2 + n, 1e-9)
    w = ahead = np.zeros(len(rules))
    b = ahead_b = start
    t = 1.0
    for _ in range(STEPS):
        error = sigmoid(centred @ ahead + ahead_b) - y
        new = ahead - step * (centred.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * LASSO, 0)
        new_b = ahead_b - step * error.mean()
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_b = new + (t - 1) / s * (new - w), new_b + (t - 1) / s * (new_b - b)
        w, b, t = new, new_b, s
    kept = np.flatnonzero(w)
    bias = float(b - mean @ w)
    return Ensemble(bias, tuple(rules[i] for i in kept), tuple(float(w[i]) for i in kept))


def train(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> Ensemble:
    """Fit on at most ``bound`` labelled rows of ``documents(doc_id, text)`` and ``labels(doc_id, quality)``."""
    rows = training_rows(documents, labels, "quality", 4, 2, bound)
    table = with_statistics(rows).drop("text").toArrow()
    order = np.argsort(table["doc_id"].to_numpy(), kind="stable")
    x = np.stack([table["stat_" + s].to_numpy() for s in STATISTICS], axis=1)[order]
    return fit(x, table["label"].to_numpy().astype(float)[order])


def scored(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``documents``: doc_id, held_out, score, predicted.

    Null and empty texts have statistics of 0 and are scored by them; without any labelled row all
    scores are near 0. Repeated rows are scored one by one; other columns are ignored.
    """
    ensemble = train(documents, labels)
    rows = documents.select("doc_id", "text", held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    score = ensemble.column().alias("score")
    return with_statistics(rows).select("doc_id", "held_out", score).select("*", predicted(F.col("score"), threshold))


def predicted(score: Column, threshold: float = THRESHOLD) -> Column:
    return (score >= threshold).cast("int").alias("predicted")
