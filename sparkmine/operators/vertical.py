"""Support counts by vertical bitmaps.

Baskets are cut into ranges. In a range each frequent item that occurs has a bitmap of the baskets that hold it; the baskets
of an itemset are the AND of its items' bitmaps, and its count the bits set. Equal baskets are one row with a weight: the weights
are cut into binary digits, each a bitmap of its own, and the count is the sum of the digits' counts. A level is one pass over
the ranges with one sum per task and candidate, however long the itemsets are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE = 1 << 14  # baskets in a range
RANGE_BYTES = 32 << 20  # of bitmaps in a range; it is cut short before they take more
TOGETHER_BYTES = 8 << 20  # of bitmaps combined at once

RANGES = "held array<int>, bits binary, weights array<bigint>"


def bitmap_ranges(baskets: DataFrame, names: list) -> DataFrame:
    """``held, bits, weights`` per range of ``baskets(items, weight)``; ``held`` numbers the items as ``names`` has them.

    ``bits`` has a row of ``RANGE`` / 8 bytes for each item in ``held``. ``names`` must be few enough to broadcast.
    """
    shared = baskets.sparkSession.sparkContext.broadcast(names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: i for i, name in enumerate(shared.value)}
        weights: list[int] = []
        items: list[np.ndarray] = []
        present: set[int] = set()

        def close() -> pa.RecordBatch:
            held = np.array(sorted(present), np.int32)
            bits = np.zeros((len(held), RANGE // 8), np.uint8)
            owner = np.repeat(np.arange(len(items)), [len(x) for x in items])
            row = np.searchsorted(held, np.concatenate(items))
            np.bitwise_or.at(bits, (row, owner >> 3), (1 << (owner & 7)).astype(np.uint8))
            columns = [
                pa.array([held], pa.list_(pa.int32())),
                pa.array([bits.tobytes()], pa.binary()),
                pa.array([weights], pa.list_(pa.int64())),
            ]
            made = pa.RecordBatch.from_arrays(columns, names=["held", "bits", "weights"])
            for column in (weights, items, present):
                column.clear()
            return made

        for batch in batches:
            for names_in, weight in zip(batch.column("items").to_pylist(), batch.column("weight").to_pylist(), strict=True):
                numbers = np.array([number[name] for name in names_in], np.int64)
                items.append(numbers)
                weights.append(weight)
                present.update(numbers.tolist())
                if len(weights) == RANGE or len(present) * RANGE // 8 > RANGE_BYTES:
                    yield close()
        if weights:
            yield close()

    return baskets.select("items", "weight").mapInArrow(pack, RANGES)


def counts_in(held: np.ndarray, bits: np.ndarray, weights: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Count of each candidate, a row of item numbers, in one range."""
    counts = np.zeros(len(candidates), np.int64)
    if not len(held):
        return counts
    at = np.minimum(np.searchsorted(held, candidates), len(held) - 1)
    some = np.flatnonzero((held[at] == candidates).all(axis=1))
    words = bits.view(np.uint64)
    digits = []
    for digit in range(int(weights.max()).bit_length()):
        set_bits = np.zeros(words.shape[1] * 64, np.uint8)
        set_bits[: len(weights)] = (weights >> digit) & 1
        digits.append(np.packbits(set_bits, bitorder="little").view(np.uint64))
    step = max(1, TOGETHER_BYTES // (8 * words.shape[1]))
    for i in range(0, len(some), step):
        rows = at[some[i : i + step]]
        both = words[rows[:, 0]]
        for column in rows.T[1:]:
            both = both & words[column]
        for digit, mask in enumerate(digits):
            counts[some[i : i + step]] += np.bitwise_count(both & mask).sum(axis=1, dtype=np.int64) << digit
    return counts


def candidate_counts(ranges: DataFrame, candidates: np.ndarray) -> DataFrame:
    """``candidate, cnt``: number and support count of each row of ``candidates`` that occurs at all.

    ``candidates`` are rows of item numbers, few enough to broadcast.
    """
    shared = ranges.sparkSession.sparkContext.broadcast(candidates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for held, bits, weights in zip(*(batch.column(c) for c in ("held", "bits", "weights")), strict=True):
                known = held.values.to_numpy()
                rows = np.frombuffer(bits.as_buffer(), np.uint8).reshape(len(known), -1)
                total += counts_in(known, rows, weights.values.to_numpy(), shared.value)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["candidate", "cnt"])

    parts = ranges.mapInArrow(count, "candidate int, cnt bigint")
    return parts.groupBy("candidate").agg(F.sum("cnt").alias("cnt"))


def joined(level: list[tuple[int, ...]]) -> int:
    """How many itemsets one longer two of the sorted ``level`` make that differ in the last item only."""
    total = run = 0
    last = None
    for itemset in level:
        run = run + 1 if itemset[:-1] == last else 0
        total, last = total + run, itemset[:-1]
    return total


def grown(level: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """The itemsets one longer all of whose subsets one shorter are in the sorted ``level``."""
    known, found, begin = set(level), [], 0
    for end in range(1, len(level) + 1):
        if end < len(level) and level[end][:-1] == level[begin][:-1]:
            continue
        for i in range(begin, end):
            for j in range(i + 1, end):
                itemset = (*level[i], level[j][-1])
                if all(itemset[:d] + itemset[d + 1 :] in known for d in range(len(itemset) - 2)):
                    found.append(itemset)
        begin = end
    return found
