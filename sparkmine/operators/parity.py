"""Parity bitmaps of shingle sets: each shingle flips one bit, so two bitmaps differ in no more bits than the sets in shingles."""

from __future__ import annotations

import numpy as np

SLACK = 1e-9  # the filters may let a pair through on a rounding error, never stop one
PARITY_WORDS = 8  # 64-bit words of a bitmap that travels with a set, at most
PARITY_ROOM = 12  # bits per shingle in which two similar sets may differ; fewer tell little
DENSE = 512  # bitmaps made at once


def parity_words(sizes: np.ndarray, threshold: float, most: int) -> np.ndarray:
    """How many words a bitmap of a set of each size wants, a power of two; 0 where ``most`` are too few to tell."""
    apart = sizes * (1 + 1 / threshold) * (1 - threshold) / (1 + threshold)
    wanted = 1 << np.ceil(np.log2(np.maximum(apart * PARITY_ROOM / 64, 1))).astype(np.int64)
    return np.where((sizes > 0) & (wanted <= 4 * most), np.minimum(wanted, most), 0)


def wide_words(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """How many words a bitmap of a set of each size has where it is compared with all sets of like size."""
    wanted = parity_words(sizes, threshold, 1 << 40)
    return np.maximum(np.minimum(wanted, PARITY_WORDS), wanted // 4)


def bits(shingles: np.ndarray, words: int | np.ndarray) -> np.ndarray:
    """Which bit of a bitmap each shingle flips."""
    return ((shingles * 0x9E3779B1) >> 7) & (np.int64(64) * words - 1)


def bitmaps(flat: np.ndarray, sizes: np.ndarray, words: int) -> np.ndarray:
    """A row of ``words`` words for each set, in which each shingle flips one bit. Halves fold onto each other by xor."""
    out = np.empty((len(sizes), words), np.uint64)
    mixed = bits(flat, words)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    step = max(1, DENSE * PARITY_WORDS // words)
    for i in range(0, len(sizes), step):
        some = sizes[i : i + step]
        owner = np.repeat(np.arange(len(some)), some)
        slot = owner * 64 * words + mixed[ends[i] : ends[i + len(some)]]
        odd = np.bincount(slot, minlength=64 * words * len(some)) & 1
        out[i : i + step] = np.packbits(odd.astype(np.uint8)).view(np.uint64).reshape(len(some), words)
    return out


def folded(x: np.ndarray, words: int) -> np.ndarray:
    """Rows of bitmaps made ``words`` wide, which they are at least."""
    while x.shape[1] > words:
        x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
    return x


def bits_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits rows of bitmaps differ; the wider ones are folded."""
    words = min(x.shape[1], y.shape[1])
    return np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(axis=1, dtype=np.int64)
