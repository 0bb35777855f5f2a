"""CRC-32 of every run of k characters of many texts at once, in Arrow batches.

Each step is taken for all runs together. Runs begin at characters, so one of k characters has k to 4k bytes.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18  # of text looked at together; work arrays take some forty times that
POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected


def crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


TABLE = crc_table()


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins; null counts as empty."""
    array = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes each, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, side="right")))
        yield i, j
        i = j


@functools.cache
def byte_tables(length: int) -> tuple[list[np.ndarray], np.ndarray | None, np.uint32]:
    """What each two bytes of a run of ``length`` bytes add to its CRC by xor, what a last single one adds, and the CRC of zeros."""
    single = [TABLE]
    for _ in range(length - 1):
        single.append(TABLE[single[-1] & 0xFF] ^ (single[-1] >> 8))
    both = np.arange(1 << 16)
    pairs = [single[length - 1 - i][both & 0xFF] ^ single[length - 2 - i][both >> 8] for i in range(0, length - 1, 2)]
    return pairs, TABLE if length % 2 else None, np.uint32(zlib.crc32(bytes(length)))


def window_hashes(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of each run of ``k`` characters in order, and how many each text has.

    A CRC is the xor of what each byte adds by its place, so runs of k bytes are hashed wherever they begin, and longer ones
    by their length.
    """
    plain = not len(raw) or int(raw.max()) < 0x80
    starts = None if plain else np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    first = offsets if plain else np.searchsorted(starts[:-1], offsets)
    chars = np.diff(first)
    counts = np.maximum(chars - k + 1, 0)
    begins = np.ones(int(first[-1]), bool)
    for back in range(1, k):  # runs do not begin at the last characters of a text
        begins[(first[1:] - back)[chars >= back]] = False
    pairs, last, zeros = byte_tables(k)
    both = (raw[:-1] | raw[1:].astype(np.uint16) << np.uint16(8)).astype(np.intp)
    n = max(0, len(raw) - k + 1)
    found = np.full(n, zeros, np.uint32)
    for i, table in enumerate(pairs):
        found ^= table[both[2 * i : 2 * i + n]]
    if last is not None:
        found ^= last[raw[k - 1 : k - 1 + n]]
    if plain:
        return found[begins[:n]], counts
    at = np.flatnonzero(begins)
    begin = starts[at]
    length = starts[at + k] - begin
    out = found[begin]
    some = np.flatnonzero(length != k)
    longer = length[some]
    for size in np.unique(longer).tolist():
        own = some[longer == size]
        where = begin[own]
        pairs, last, zeros = byte_tables(size)
        state = np.full(len(own), zeros, np.uint32)
        for i, table in enumerate(pairs):
            state ^= table[both[where + 2 * i]]
        if last is not None:
            state ^= last[raw[where + size - 1]]
        out[own] = state
    return out, counts


def parts_of(raw: np.ndarray, k: int, size: int = SLICE_BYTES) -> Iterator[np.ndarray]:
    """A long text cut at characters into parts of about ``size`` bytes that overlap by ``k`` - 1 characters."""
    begin = 0
    while True:
        end = begin + size
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        yield raw[begin:end]
        if end >= len(raw):
            return
        for _ in range(k - 1):  # back over the last characters
            end -= 1
            while raw[end] & 0xC0 == 0x80:
                end -= 1
        begin = max(end, begin + 1)


def distinct_sets(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text, sorted, and how many each has."""
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    both = np.sort((owner << np.uint64(32)) | hashes)
    both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
    sizes = np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=len(counts))
    return (both & np.uint64(0xFFFFFFFF)).astype(np.int64), sizes


def hash_lists(texts: pa.Array, k: int, distinct: bool) -> pa.Array:
    """A list of the hashes of each text; null and short texts have an empty one."""
    values, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, j in slices(texts):
        found, counts = window_hashes(*flat(texts.slice(i, j - i)), k)
        if distinct:
            found, counts = distinct_sets(found, counts)
        values.append(found.astype(np.int64))
        sizes.append(counts)
    ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))


def set_summaries(texts: pa.Array, k: int) -> pa.Array:
    """Number, least, greatest and sum of the distinct hashes of each text; the last three are null without any."""
    out = np.zeros((4, len(texts)), np.int64)
    for i, j in slices(texts):
        found, sizes = distinct_sets(*window_hashes(*flat(texts.slice(i, j - i)), k))
        out[0, i:j] = sizes
        some = np.flatnonzero(sizes)
        if len(some):
            ends = np.cumsum(sizes)[some]
            begins = ends - sizes[some]
            out[1, i + some], out[2, i + some] = found[begins], found[ends - 1]
            out[3, i + some] = np.add.reduceat(found, begins)
    none = out[0] == 0
    columns = [pa.array(out[0]), *(pa.array(values, mask=none) for values in out[1:])]
    return pa.StructArray.from_arrays(columns, ["n", "least", "greatest", "total"])


def set_counts(texts: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts, the hashes that occur and in how many of the run's texts."""
    for i, j in slices(texts):
        yield np.unique(distinct_sets(*window_hashes(*flat(texts.slice(i, j - i)), k))[0], return_counts=True)
