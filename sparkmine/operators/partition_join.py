"""Candidates of the exact self-join among large sets, by partitions that two similar sets must have in common.

Shingles are dealt by a hash over more partitions than two similar sets can have differences (Arasu et al. 2006), so
some partition has the same shingles on both sides. A *token* is a partition with its shingles. Let two sets have at most
d differences: at most d tokens of either are not the other's, so among the first d + 1 tokens of each, in any order of all
tokens, there is one of both. Tokens of many rare shingles come first: unrelated sets seldom agree in one of them.

A token is a number of 40 bits. It travels packed with those of some thousand sets, about four bytes each. What meets is lists of
sets with one token, and of these only lists of two and more go on, dealt by their first set, so that lists of one cluster
come together and its pairs are formed there. The parity bitmaps of the sets come to them, and only pairs that these allow become rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions import windows
from sparkmine.operators.parity import SLACK, bitmaps, bits_apart, wide_words
from sparkmine.operators.skew import ARRAY_ROWS, salted_join
from sparkmine.operators.storage import durable, release

LEAST_THRESHOLD = 0.75  # below it a partition has too few shingles to tell sets apart
SPARE = 1.25  # partitions for each token that is needed of the largest set of a class
KEY_BITS = 40  # two tokens in 2^40 are one by chance, which costs a comparison of two bitmaps
REF_BITS = 17  # of the number of a set among those that a task packs together
TOGETHER = 4_096  # sets whose tokens are sorted at once; with the sort key of 52 bits that fits 64
RARE_BITS = 20  # shingles are counted by their low bits
RARE_CHARS = 700  # at the beginning of each text; any order of tokens is exact
COMMONEST = 8  # of a shingle that is one of 2^8 of all, or more, the weight is 0; two bits rarer, it is one more, up to 7
PACKED = 2_000_000  # tokens that are packed together, and of a bucket
LIST_SETS = 512  # of a longer list, each two parts are a list
SHORT_LIST = 16
TILE = 1_024  # sets of long lists that are paired at once with as many others
PAIRS_AT_ONCE = 2_000_000


def differences(sizes: np.ndarray, threshold: float, most: np.ndarray | int) -> np.ndarray:
    """In how many shingles a set of each size can differ from a similar one of at most ``most`` shingles."""
    return np.floor((sizes + most) * ((1 - threshold) / (1 + threshold) + SLACK) + SLACK).astype(np.int64)


def partitions(scheme: np.ndarray, threshold: float) -> np.ndarray:
    """Into how many partitions sets are dealt where the smaller of two has 2^scheme shingles or more, but not twice as many."""
    return np.ceil(SPARE * ((2 << scheme) * (1 - threshold) / threshold + 1)).astype(np.int64)


def schemes(sizes: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sets, their schemes and the tokens that they need there: once as either of two, once as the larger with a smaller class."""
    own = np.frexp(sizes.astype(np.float64))[1].astype(np.int64) - 1
    largest = np.floor(sizes / threshold + SLACK * sizes).astype(np.int64)
    yield np.arange(len(sizes)), own, differences(sizes, threshold, largest) + 1
    below = (1 << own) - 1  # the largest set of the class below
    some = np.flatnonzero(sizes * (threshold - SLACK) <= below)
    yield some, own[some] - 1, differences(sizes[some], threshold, below[some]) + 1


def mixed(x: np.ndarray, factor: int) -> np.ndarray:
    x = x * np.uint64(factor)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def rarity(texts: DataFrame, k: int) -> np.ndarray:
    """A weight from 0 to 7 for each bucket of shingles, more for rarer ones, by the beginnings of ``texts``."""
    buckets = 1 << RARE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.uint32)
        for batch in batches:
            for i, j in windows.slices(batch.column(0)):
                found, _ = windows.window_hashes(*windows.flat(batch.column(0).slice(i, j - i)), k)
                counts += np.bincount(found & np.uint32(buckets - 1), minlength=buckets).astype(np.uint32)
        for part, held in enumerate(np.split(counts, 16)):
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([held.tobytes()], pa.binary())], names=["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(held, np.uint32).astype(np.int64) for held in table.column("counts").to_pylist())
        return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    heads = texts.select(F.substring("normalized", 1, RARE_CHARS))
    counted = heads.mapInArrow(count, "part bigint, counts binary").groupBy("part").applyInArrow(add, "part bigint, counts binary")
    counts = np.zeros((16, buckets // 16), np.int64)
    for row in counted.collect():
        counts[row["part"]] = np.frombuffer(row["counts"], np.int64)
    share = np.log2((counts.sum() + 1) / (counts.ravel() + 1))
    return np.clip((share - COMMONEST) / 2, 0, 7).astype(np.uint8)


def tokens(flat: np.ndarray, sizes: np.ndarray, threshold: float, rare: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Number of the set and key of each token that the sets need, and the sets that have not as many.

    ``flat`` are the shingles of at most ``TOGETHER`` sets, each sorted.
    """
    shingles = flat.astype(np.uint64)
    weight = rare[flat & ((1 << RARE_BITS) - 1)].astype(np.float64)
    spread = mixed(shingles, 0x9E3779B97F4A7C15) >> np.uint64(32)
    value = (mixed(shingles, 0xD6E8FEB86659FD93) >> np.uint64(20)).astype(np.float64)  # sums of some hundred are exact
    starts = np.cumsum(sizes) - sizes
    for some, scheme, need in schemes(sizes, threshold):
        if not len(some):
            continue
        n = sizes[some]
        if len(some) < len(sizes):
            at = np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            dealt, summed, weighed = spread[at], value[at], weight[at]
        else:
            dealt, summed, weighed = spread, value, weight
        parts = partitions(scheme, threshold)
        first = np.cumsum(parts) - parts
        slot = (dealt * np.repeat(parts.astype(np.uint64), n) >> np.uint64(32)).astype(np.int64) + np.repeat(first, n)
        heavy = np.bincount(slot, weighed, minlength=int(parts.sum()))
        total = np.bincount(slot, summed, minlength=int(parts.sum()))
        owner = np.repeat(np.arange(len(some)), parts)
        filled = np.flatnonzero(total)  # a shingle whose value is 0 is as if it were not there, in every set
        owner, light = owner[filled], 63 - np.minimum(heavy[filled], 63)
        named = (filled - first[owner]) | (scheme[owner] << 32)
        key = mixed(total[filled].astype(np.uint64) ^ mixed(named.astype(np.uint64), 0x9E3779B97F4A7C15), 0xFF51AFD7ED558CCD)
        key >>= np.uint64(64 - KEY_BITS)
        ordered = np.sort(owner.astype(np.uint64) << np.uint64(52) | light.astype(np.uint64) << np.uint64(46) | key)
        have = np.bincount(owner, minlength=len(some))
        owner = (ordered >> np.uint64(52)).astype(np.int64)
        place = np.arange(len(ordered)) - (np.cumsum(have) - have)[owner]
        kept = place < need[owner]
        yield some[owner[kept]], ordered[kept] & np.uint64((1 << KEY_BITS) - 1), some[have < need]


def packed(keys: np.ndarray, sets: np.ndarray, count: int, buckets: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """``bucket, tokens, shift, start, data``: tokens of ``count`` sets, sorted, as differences, byte by byte of all of them."""
    shift = max(1, (count - 1).bit_length())
    rows = np.sort(keys << np.uint64(shift) | sets.astype(np.uint64))
    bucket = ((rows >> np.uint64(shift)) * np.uint64(buckets) >> np.uint64(KEY_BITS)).astype(np.int64)
    begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(rows) else bucket
    for i, j in zip(begins.tolist(), [*begins[1:].tolist(), len(rows)], strict=True):
        apart = np.diff(rows[i:j], prepend=rows[i])
        width = max(1, (int(apart.max()).bit_length() + 7) // 8)
        data = np.ascontiguousarray(apart.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
        yield int(bucket[i]), j - i, shift, int(rows[i]), data


def unpacked(count: int, shift: int, start: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys and numbers of the sets."""
    apart = np.zeros((count, 8), np.uint8)
    width = len(data) // count
    apart[:, :width] = np.frombuffer(data, np.uint8).reshape(width, count).T
    rows = np.cumsum(apart.view("<u8").ravel(), dtype=np.uint64) + np.uint64(start)
    return rows >> np.uint64(shift), rows & np.uint64((1 << shift) - 1)


SIGNED = "bucket int, base bigint, tokens bigint, shift int, start bigint, data binary, size bigint, weak boolean"


def signed(texts: DataFrame, k: int, threshold: float, least: int, buckets: int) -> DataFrame:
    """Packed tokens of the sets of ``least`` shingles or more, by bucket, and the sets with their bitmaps, in buckets below 0.

    A set's place is ``base`` and its number among those that are packed together; base is made of the partition, so a task that runs
    again gives the same. ``weak`` sets have too few tokens.
    """
    shared = texts.sparkSession.sparkContext.broadcast(rarity(texts, k))
    schema = f"{SIGNED}, group_id {texts.schema['group_id'].dataType.simpleString()}"
    names = [part.split()[0] for part in schema.split(", ")]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 20
        keys, owners, held, sets = [], [], 0, 0
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]

        def rows(kind: pa.DataType, count: int, **given) -> pa.RecordBatch:
            columns = [given.get(n, pa.nulls(count, t)) for n, t in zip(names, [*kinds, kind], strict=True)]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, [*kinds, kind], strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def flush(kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            for bucket, count, shift, start, data in packed(np.concatenate(keys), np.concatenate(owners), sets, buckets):
                yield rows(kind, 1, bucket=[bucket], base=[run << REF_BITS], tokens=[count], shift=[shift], start=[start], data=[data])

        for batch in batches:
            kind = batch.schema.field("group_id").type
            array = batch.column("normalized")
            for i, j in windows.slices(array):
                for a in range(i, j, TOGETHER):
                    b = min(j, a + TOGETHER)
                    flat, sizes = windows.distinct_sets(*windows.window_hashes(*windows.flat(array.slice(a, b - a)), k))
                    some = np.flatnonzero(sizes >= least)
                    if not len(some):
                        continue
                    flat, sizes = flat[np.repeat(sizes >= least, sizes)], sizes[some]
                    if held and (held >= PACKED or sets + len(some) > 1 << REF_BITS):
                        yield from flush(kind)
                        keys, owners, held, sets = [], [], 0, 0
                        run += 1
                    weak = np.zeros(len(some), bool)
                    for owner, key, few in tokens(flat, sizes, threshold, shared.value):
                        keys.append(key)
                        owners.append(owner + sets)
                        held += len(key)
                        weak[few] = True
                    words, parity = wide_words(sizes, threshold), np.full(len(sizes), b"", object)
                    for count in np.unique(words).tolist():
                        made = bitmaps(flat[np.repeat(words == count, sizes)], sizes[words == count], count)
                        parity[words == count] = [row.tobytes() for row in made]
                    yield rows(
                        kind,
                        len(some),
                        bucket=-1 - (np.arange(len(some)) + run) % buckets,
                        base=np.arange(len(some)) + (sets + (run << REF_BITS)),
                        data=pa.array(parity, pa.binary()),
                        size=sizes,
                        weak=weak,
                        group_id=batch.column("group_id").slice(a, b - a).take(pa.array(some)),
                    )
                    sets += len(some)
        if held:
            yield from flush(kind)

    return texts.select("group_id", "normalized").mapInArrow(sign, schema)


def equal_runs(keys: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The refs of keys that come more than once, key by key and sorted, and how many each key has."""
    spare = 64 - max(1, len(keys).bit_length())
    low = keys.min()
    if int(keys.max() - low).bit_length() <= spare:
        both = np.sort((keys - low) << np.uint64(64 - spare) | np.arange(len(keys), dtype=np.uint64))
        order, keys = (both & np.uint64((1 << (64 - spare)) - 1)).astype(np.int64), both >> np.uint64(64 - spare)
    else:
        order = np.argsort(keys)
        keys = keys[order]
    fresh = np.append(True, keys[1:] != keys[:-1])
    alone = fresh & np.append(fresh[1:], True)
    run, refs = np.cumsum(fresh[~alone]), refs[order[~alone]]
    at = np.lexsort((refs, run))
    return refs[at], np.bincount(run)[1:] if len(run) else run


def cut(refs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of at most some ``2 * LIST_SETS`` refs in which all pairs of the given lists are, their sizes, and where each belongs."""
    starts = np.cumsum(sizes) - sizes
    home = refs[starts]
    if sizes.max(initial=0) <= 2 * LIST_SETS:
        return refs, sizes, home
    many, counts, homes = [refs[np.repeat(sizes <= 2 * LIST_SETS, sizes)]], [sizes[sizes <= 2 * LIST_SETS]], [home[sizes <= 2 * LIST_SETS]]
    for at in np.flatnonzero(sizes > 2 * LIST_SETS).tolist():
        own = refs[starts[at] : starts[at] + sizes[at]]
        parts = 1 << math.ceil(math.log2(sizes[at] / LIST_SETS))
        part = mixed(own, 0x9E3779B97F4A7C15) >> np.uint64(40) & np.uint64(parts - 1)
        blocks = [own[part == p] for p in range(parts)]
        for i in range(parts):
            for j in range(i + 1, parts):
                both = np.sort(np.concatenate([blocks[i], blocks[j]]))
                if len(both) > 1:
                    many.append(both)
                    counts.append(np.array([len(both)]))
                    homes.append(home[at : at + 1] + np.uint64(i * parts + j << 44))
    return np.concatenate(many), np.concatenate(counts), np.concatenate(homes)


def pairs_of_short(code: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Pairs of numbers, as one of 32 bits each, in lists of which few are long."""
    for m in np.unique(sizes).tolist():
        lists = starts[sizes == m]
        i, j = np.triu_indices(m, 1)
        step = max(1, PAIRS_AT_ONCE // len(i))
        for at in range(0, len(lists), step):
            members = code[lists[at : at + step, None] + np.arange(m)]
            yield np.unique((members[:, i] << 32 | members[:, j]).ravel())


def pairs_of_long(code: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The same of longer lists: those that begin alike are mostly alike, so a product of matrices finds each pair of them once."""
    order = np.argsort(code[starts], kind="stable")
    begins = np.flatnonzero(np.append(True, np.diff(code[starts][order]) != 0))
    for i, j in zip(begins, np.append(begins[1:], len(order)), strict=True):
        some = sizes[order[i:j]]
        at = np.repeat(starts[order[i:j]] - (np.cumsum(some) - some), some) + np.arange(some.sum())
        members, place = np.unique(code[at], return_inverse=True)
        owner = np.repeat(np.arange(len(some)), some)
        for x in range(0, len(members), TILE):
            for y in range(x, len(members), TILE):
                wide, high = min(TILE, len(members) - x), min(TILE, len(members) - y)
                common = np.zeros((wide, high), np.float32)
                for first in range(0, len(some), TILE):
                    rows = min(TILE, len(some) - first)
                    now = (owner >= first) & (owner < first + TILE)
                    sides = []
                    for low, width in ((x, wide), (y, high)):
                        side = np.zeros((rows, width), np.float32)
                        here = now & (place >= low) & (place < low + width)
                        side[owner[here] - first, place[here] - low] = 1
                        sides.append(side)
                    common += sides[0].T @ sides[1]
                one, two = np.nonzero(common)
                one, two = members[one + x], members[two + y]
                yield (one << 32 | two)[one < two]


def pairs_in(refs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The refs in order, and every pair of them that is in one list, once, as numbers of 32 bits; lists are sorted."""
    names, code = np.unique(refs, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    found, made, held = np.empty(0, np.int64), [], 0
    few = sizes <= SHORT_LIST
    for some, pairs in ((few, pairs_of_short), (~few, pairs_of_long)):
        for more in pairs(code, starts[some], sizes[some]):
            made.append(more)
            held += len(more)
            if held > max(2 * PAIRS_AT_ONCE, len(found)):
                found, made, held = np.unique(np.concatenate([found, *made])), [], 0
    return names, np.unique(np.concatenate([found, *made]))


def token_lists(dealt: DataFrame, buckets: int) -> DataFrame:
    """``part, refs, sizes``: lists of the sets that have a token in common, packed by where they belong; rows of sets pass."""
    passed = ["base", "data", "size", "weak", "group_id"]
    schema = f"part int, refs binary, sizes binary, {', '.join(f'{c} {dealt.schema[c].dataType.simpleString()}' for c in passed)}"

    def meet(table: pa.Table) -> pa.Table:
        types = [pa.int32(), pa.binary(), pa.binary(), *(table.schema.field(c).type for c in passed)]
        names = ["part", "refs", "sizes", *passed]
        if table.column("bucket")[0].as_py() < 0:
            return pa.table([*(pa.nulls(len(table), t) for t in types[:3]), *(table.column(c) for c in passed)], names=names)
        keys, refs = [], []
        for count, shift, start, data, base in zip(*(table.column(c).to_pylist() for c in ("tokens", "shift", "start", "data", "base")), strict=True):
            key, own = unpacked(count, shift, start, data)
            keys.append(key)
            refs.append(own + np.uint64(base))
        lists, sizes, home = cut(*equal_runs(np.concatenate(keys), np.concatenate(refs)))
        part = (mixed(home, 0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)
        order = np.argsort(part, kind="stable")
        starts = np.cumsum(sizes) - sizes
        some = sizes[order]
        lists = lists[np.repeat(starts[order] - (np.cumsum(some) - some), some) + np.arange(some.sum())]
        part = part[order]
        begins = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, np.int64)
        ends, at = np.append(begins[1:], len(part)), np.append(0, np.cumsum(some))
        columns = [
            part[begins],
            [lists[at[i] : at[j]].tobytes() for i, j in zip(begins, ends, strict=True)],
            [some[i:j].astype(np.int32).tobytes() for i, j in zip(begins, ends, strict=True)],
            *[[None] * len(begins)] * len(passed),
        ]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return dealt.groupBy("bucket").applyInArrow(meet, schema)


def met_in_parts(lists: DataFrame, places: int) -> DataFrame:
    """``part, pairs, ref``: the pairs of sets that are in one list, packed as numbers of refs of the part, and these refs in order."""

    def expand(table: pa.Table) -> pa.Table:
        refs, sizes = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("refs", np.int64), ("sizes", np.int32)))
        names, found = pairs_in(refs, sizes.astype(np.int64))
        part = np.full(len(names) + 1, table.column("part")[0].as_py(), np.int32)
        pairs = pa.array([found.tobytes(), *[None] * len(names)], pa.binary())
        return pa.table([pa.array(part), pairs, pa.array([None, *names.tolist()], pa.int64())], names=["part", "pairs", "ref"])

    rows = lists.filter("part is not null").select("part", "refs", "sizes").repartition(places, "part")
    return rows.groupBy("part").applyInArrow(expand, "part int, pairs binary, ref bigint")


def allowed(met: DataFrame, sets: DataFrame, threshold: float, places: int) -> DataFrame:
    """``id1, id2`` of the pairs in ``met`` whose sizes and bitmaps, from ``sets(ref, size, parity, group_id)``, allow the threshold."""
    kind = sets.schema["group_id"].dataType.simpleString()
    wanted = met.filter("ref is not null").select("part", "ref")
    here = salted_join(wanted, sets.hint("merge"), ["ref"], ARRAY_ROWS).withColumnRenamed("part", "own").repartition(places, "own")
    pairs = met.filter("pairs is not null").select("part", "pairs").repartition(places, "part")

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("ref")
        size, ids = right.column("size").to_numpy(), right.column("group_id").combine_chunks()
        found = np.frombuffer(b"".join(left.column("pairs").to_pylist()), np.int64)
        a, b = found >> 32, found & 0xFFFFFFFF
        fits = np.minimum(size[a], size[b]) >= np.maximum(size[a], size[b]) * threshold - SLACK
        a, b = a[fits], b[fits]
        parity = right.column("parity")
        words = np.fromiter((len(x) for x in parity.to_pylist()), np.int64, len(size)) // 8
        place, held = np.zeros(len(size), np.int64), {}
        for w in np.unique(words).tolist():
            at = np.flatnonzero(words == w)
            place[at] = np.arange(len(at))
            held[w] = np.frombuffer(b"".join(parity.take(pa.array(at)).to_pylist()), np.uint64).reshape(-1, w)
        kept = np.zeros(len(a), bool)
        for u, v in {*zip(words[a].tolist(), words[b].tolist(), strict=True)}:
            some = np.flatnonzero((words[a] == u) & (words[b] == v))
            step = max(1, (1 << 20) // max(u, v))
            for i in range(0, len(some), step):
                x, y = a[some[i : i + step]], b[some[i : i + step]]
                n = size[x] + size[y]
                kept[some[i : i + step]] = n - bits_apart(held[u][place[x]], held[v][place[y]]) >= 2 * n * (threshold / (1 + threshold) - SLACK)
        one, two = (ids.take(pa.array(c[kept])) for c in (a, b))
        first = pc.less(one, two)
        return pa.table([pc.if_else(first, one, two), pc.if_else(first, two, one)], names=["id1", "id2"])

    return pairs.groupBy("part").cogroup(here.groupBy("own")).applyInArrow(near, f"id1 {kind}, id2 {kind}")


def token_candidates(texts: DataFrame, k: int, threshold: float, least: int) -> tuple[DataFrame, DataFrame] | None:
    """``id1, id2`` of the sets of at least ``least`` shingles that have a needed token in common and bitmaps that allow the
    threshold, some of them several times, and ``group_id`` of those that have too few tokens to be found by them. Both are durable.

    ``texts`` are those of which a set fits an array; nothing is returned if none is long enough.
    """
    texts = texts.filter(F.length("normalized") - k + 1 >= least)
    chars = texts.agg(F.sum(F.length("normalized"))).first()[0]
    if not chars:
        return None
    each = 1.5 * (1 - threshold) / threshold  # tokens of a shingle, rather more
    buckets = max(16, math.ceil(chars * each / PACKED))
    places = min(buckets, 10_000)  # buckets are much work for few bytes
    signs = signed(texts, k, threshold, least, buckets)
    lists = durable(token_lists(signs.repartition(places, "bucket"), buckets), "lists")
    met = durable(met_in_parts(lists, places), "met")
    sets = lists.filter("part is null").select(F.col("base").alias("ref"), "size", F.col("data").alias("parity"), "group_id", "weak")
    many = durable(allowed(met, sets.drop("weak"), threshold, places), "many")
    weak = durable(sets.filter("weak").select("group_id"), "weak")
    release(lists, met)
    return many, weak
