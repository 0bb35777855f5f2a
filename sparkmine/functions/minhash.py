"""MinHash signatures and LSH bands."""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmine.functions import windows

# The modulus (smallest prime above 2**32) and the seed of the hash family.
PRIME = 4294967311
SEED = 42
EMPTY = (1 << 63) - 1  # stands for infinity, above every hash value

UNSURE = 32  # of 2**32 parts behind the point: a rounded value may be past the next whole number by 17 of them

SLICE_VALUES = 32_768  # shingles hashed at a time, so that the work arrays stay in cache
TEXT_BYTES = 1 << 15  # of text hashed at a time


def hash_family(n: int, seed: int = SEED) -> list[tuple[int, int]]:
    """``n`` coefficient pairs of h(x) = (a·x + b) mod PRIME."""
    if n <= 0:
        raise ValueError("number of hashes must be positive")
    rng = random.Random(seed)
    family = []
    for _ in range(n):
        a = rng.randint(1, PRIME - 1)
        family.append((a, rng.randint(0, PRIME - 1)))
    return family


def _fold(v: np.ndarray) -> np.ndarray:
    """v = hi·2**32 + lo as lo − 15·hi, congruent since PRIME = 2**32 + 15; 15·PRIME keeps it positive."""
    return (v & np.uint64(0xFFFFFFFF)) + np.uint64(15 * PRIME) - (v >> np.uint64(32)) * np.uint64(15)


def _hash(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """(a·x + b) mod PRIME for 32-bit x in unsigned 64-bit arithmetic, without division."""
    if a < 1 << 32:
        v = _fold(x * np.uint64(a))  # the product fits; v < 17·PRIME
    else:
        v = np.uint64(15 * PRIME) - x * np.uint64(PRIME - a)  # a ≡ −(PRIME − a), which is at most 15
    v += np.uint64(b)
    hi = v >> np.uint64(32)  # at most 18
    v = (v & np.uint64(0xFFFFFFFF)) - hi * np.uint64(15)  # wraps around if negative
    return np.minimum(v, v + np.uint64(PRIME))


def _scaled(a: int, b: int) -> tuple[np.uint64, np.uint64]:
    """Factor and summand with which a 64-bit product that wraps around is h(x) · 2**64 / PRIME, rounded up.

    Both are rounded to the nearest, which moves the product by at most 2**31 for a 32-bit x; the summand makes up
    for that, so the value lies less than 2**32 + 2 above the exact one, and never below it.
    """
    factor, summand = (((c << 64) + PRIME // 2) // PRIME for c in (a, b))
    return np.uint64(factor), np.uint64((summand + (1 << 31) + 1) % (1 << 64))


def _unscaled(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """u · PRIME / 2**64 as whole part and 32 bits behind the point."""
    hi = u >> np.uint64(32)
    lo = u & np.uint64(0xFFFFFFFF)
    rest = lo + hi * np.uint64(15) + (lo * np.uint64(15) >> np.uint64(32))
    return hi + (rest >> np.uint64(32)), rest & np.uint64(0xFFFFFFFF)


def signatures_of(flat: np.ndarray, starts: np.ndarray, family: Sequence[tuple[int, int]]) -> np.ndarray:
    """Signature of each run of ``flat``; run i begins at ``starts[i]`` and none is empty.

    The least scaled value of a run tells the least hash, unless it lies so near a whole number that the rounding may
    have moved it past another; these few, one in some hundred million, are taken from the hashes themselves.
    """
    least = np.empty((len(starts), len(family)), dtype=np.uint64)
    work = np.empty(len(flat), np.uint64)
    for i, (a, b) in enumerate(family):
        factor, summand = _scaled(a, b)
        np.multiply(flat, factor, out=work)
        np.add(work, summand, out=work)
        least[:, i] = np.minimum.reduceat(work, starts)
    out, behind = _unscaled(least)
    ends = np.append(starts[1:], len(flat))
    for row, i in zip(*np.nonzero(behind < UNSURE), strict=True):
        out[row, i] = _hash(flat[starts[row] : ends[row]], *family[i]).min()
    return out.astype(np.int64)


def minhash(shingles: Column, n: int = 100, seed: int = SEED) -> Column:
    """MinHash signature (array<bigint>, length n) of an array of 32-bit shingle hashes.

    Repeats in the array do not matter. An empty or null array gives ``EMPTY`` at every position.
    """
    family = hash_family(n, seed)

    @F.arrow_udf("array<bigint>")
    def signature(batch: pa.Array) -> pa.Array:
        values = batch.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
        sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        out = np.full((len(batch), n), EMPTY, dtype=np.int64)
        filled = np.flatnonzero(sizes)
        i = 0
        while i < len(filled):
            base = begins[filled[i]]
            # as many whole sets as fit into a slice, at least one
            j = max(i + 1, int(np.searchsorted(ends[filled], base + SLICE_VALUES, side="right")))
            rows = filled[i:j]
            out[rows] = signatures_of(values[base : ends[rows[-1]]], begins[rows] - base, family)
            i = j
        offsets = pa.array(np.arange(0, (len(batch) + 1) * n, n, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

    return signature(shingles)


def text_signature(normalized: Column, k: int, n: int = 100, seed: int = SEED) -> Column:
    """:func:`minhash` of the shingles of a text, none of which is written down.

    A long text is hashed in parts, whose signatures have the text's as their least.
    """
    family = hash_family(n, seed)

    @F.arrow_udf("array<bigint>")
    def signature(batch: pa.Array) -> pa.Array:
        out = np.full((len(batch), n), EMPTY, dtype=np.int64)
        for i, j in windows.slices(batch, TEXT_BYTES):
            raw, offsets = windows.flat(batch.slice(i, j - i))
            if len(raw) > 2 * TEXT_BYTES:  # a single text
                for part in windows.parts_of(raw, k, TEXT_BYTES):
                    hashes, counts = windows.window_hashes(part, np.array([0, len(part)]), k)
                    if counts[0]:
                        out[i] = np.minimum(out[i], signatures_of(hashes.astype(np.uint64), np.array([0]), family)[0])
                continue
            hashes, counts = windows.window_hashes(raw, offsets, k)
            filled = np.flatnonzero(counts)
            if len(filled):
                begins = (np.cumsum(counts) - counts)[filled]
                out[i + filled] = signatures_of(hashes.astype(np.uint64), begins, family)
        offsets = pa.array(np.arange(0, (len(batch) + 1) * n, n, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))

    return signature(normalized)


def band_plan(n: int, threshold: float) -> tuple[int, int]:
    """(bands, rows) with bands · rows = n whose LSH threshold (1/bands)**(1/rows) is nearest.

    Of equally near plans the one with fewest rows wins.
    """
    plans = [(n // rows, rows) for rows in range(1, n + 1) if n % rows == 0]
    return min(plans, key=lambda plan: abs((1 / plan[0]) ** (1 / plan[1]) - threshold))


def band_keys(signature: Column, bands: int, rows: int, crc: bool = False) -> Column:
    """One key per band, as an array.

    By default a 128-bit digest of the band's values. With ``crc`` the CRC-32 of the band written as
    ``(v1, v2, …)`` with ``inf`` for an empty set, a 32-bit key in which unequal bands can meet.
    """

    def key(i: Column) -> Column:
        values = F.slice(signature, i * rows + 1, rows)
        if not crc:
            return F.unhex(F.md5(F.array_join(values, ",")))
        shown = F.transform(
            values, lambda v: F.when(v == EMPTY, F.lit("inf")).otherwise(v.cast("string"))
        )
        end = ",)" if rows == 1 else ")"
        return F.crc32(F.encode(F.concat(F.lit("("), F.array_join(shown, ", "), F.lit(end)), "UTF-8"))

    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key)
