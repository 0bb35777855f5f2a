"""Words of whole texts as 64-bit hashes, many texts at a time.

A word is a run of bytes that are not separators. All separators here are ASCII bytes, which never
occur inside a longer UTF-8 sequence, so working on bytes gives the same words as on characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21  # bytes looked at together; work arrays take some forty times that

# Words of op 1: anything between white space. Words of op 2: ASCII digits, letters and all beyond ASCII.
SPACES = bytes([*range(0x09, 0x0E), 0x20])
NON_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers whose bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_weights(separators: bytes) -> np.ndarray:
    """A random weight for each byte, A-Z like a-z, 0 for separators."""
    weights = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    weights[ord("A") : ord("Z") + 1] = weights[ord("a") : ord("z") + 1]
    weights[list(separators)] = 0
    return weights


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null counts as empty."""
    array = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes each, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(ends):
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield i, j
        i = j


def _hash_piece(piece: np.ndarray, cuts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of ``piece``, in which a text begins at each of ``cuts``."""
    value = weights[piece]
    inside = value != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    if len(cuts):
        first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = np.diff(starts, append=len(piece))
    place = np.arange(starts[0], len(piece), dtype=np.int64)
    place -= np.repeat(starts, lengths)
    powers = np.full(int(lengths.max()), 0x9E3779B97F4A7C15, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    value = value[starts[0] :] * powers[place]  # separators weigh nothing
    return starts, mixed(np.add.reduceat(value, starts - starts[0]))


def word_hashes(
    raw: np.ndarray, offsets: np.ndarray, weights: np.ndarray, size: int = CHUNK_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, in order, and the offsets of each text's words among them.

    Longer input is cut at separators, so that memory follows the words and not eightfold the bytes.
    """
    starts, hashes, begin = [], [], 0
    while begin < len(raw):
        end = min(begin + size, len(raw))
        if end < len(raw):
            gaps = np.flatnonzero(weights[raw[begin:end]] == 0)
            while not len(gaps) and end < len(raw):  # a word longer than the piece
                end = min(end + size, len(raw))
                gaps = np.flatnonzero(weights[raw[begin:end]] == 0)
            if end < len(raw):
                end = begin + int(gaps[-1]) + 1
        inner = offsets[np.searchsorted(offsets, begin) : np.searchsorted(offsets, end)] - begin
        s, h = _hash_piece(raw[begin:end], inner, weights)
        starts.append(s + begin)
        hashes.append(h)
        begin = end
    if not starts:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    bounds = np.searchsorted(np.concatenate(starts), offsets)
    return np.concatenate(hashes), bounds


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; the last k - 1 positions run past the end."""
    wide = np.zeros(len(words), np.uint64)
    for i in range(min(k, len(words))):
        part = words[i:] * np.uint64(2 * i + 3) + np.uint64(i)
        wide[: len(words) - i] = mixed(wide[: len(words) - i] ^ part) if i else mixed(part)
    return wide


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each position where a text has as many, and the texts' offsets.

    A text of fewer words, but not none, has one shingle: its whole sequence.
    """
    counts = np.diff(bounds)
    wide = grams(words, k)
    keep = np.arange(len(words)) + k <= np.repeat(bounds[1:], counts)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    for t in np.flatnonzero((counts > 0) & (counts < k)):
        at = bounds[t]
        keep[at] = True
        value = np.full(1, counts[t], np.uint64)
        for w in words[at : at + counts[t]]:
            value = mixed(value * np.uint64(0xD6E8FEB86659FD93) + w)
        wide[at] = value[0]
    return wide[keep], np.concatenate([[0], np.cumsum(sizes)])
