"""Exact self-join of shingle sets by Jaccard similarity.

Small sets take prefix filtering (Chaudhuri et al. 2006; Bayardo et al. 2007; Vernica et al. 2010): with all sets
sorted by one global order, two sets of similarity at least t share an element among the first
``n − ceil(t·n) + 1`` of each. Putting frequent shingles last keeps them out of nearly all prefixes,
so the join never meets the long posting lists that a join on all shingles would expand.

Two sets of a list become a pair only if sizes, positions and parity bitmaps allow: in a bitmap each shingle
flips one bit, so two bitmaps differ in no more bits than the sets in shingles.

A bitmap that can tell two large sets apart is too wide to travel with every element of a prefix, and without one each
chance meeting is a row. Large sets therefore meet by tokens of several shingles (``partition_join``), and only pairs that their
bitmaps allow become rows. Sets of long texts, few as they are, and all large ones at a low threshold are compared by bitmaps alone,
about a bit per shingle, class of sizes against class of sizes.

Candidates are verified by blocks of sets, each shipped once to a task that checks all pairs of two blocks.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.functions import windows
from sparkmine.functions.sets import jaccard_of_counts
from sparkmine.operators.documents import beside_pairs, long_texts, set_rows, short_texts
from sparkmine.operators.parity import PARITY_ROOM, PARITY_WORDS, SLACK, bitmaps, bits, bits_apart, folded, parity_words, wide_words
from sparkmine.operators.partition_join import LEAST_THRESHOLD, token_candidates
from sparkmine.operators.skew import ARRAY_ROWS, heavy_keys, lookup_semi, salted_join, with_parts
from sparkmine.operators.storage import broadcast_if_small, durable, release, small

BUCKET_BITS = 18  # shingles are counted by their low bits: a table of one size at any scale
TOGETHER = 8_192  # sets sorted at once; with the sort key of 50 bits that fits 64
CELL_WORDS = 128  # of the bitmaps made where sets are verified
LIST_ROWS = 2_000  # sets of one list that a task holds against as many others
CLASS_STEP = 1.05  # large sets whose sizes lie within this factor at least are in reach of each other
CLASS_REACH = 2  # classes above its own that a set must meet; each costs a copy of the bitmap and makes cells smaller
CLASS_SETS = 65_536  # large sets in a part of a class, unless there are CLASS_PARTS
CLASS_PARTS = 2  # parts of a class, unless their bitmaps are beyond PART_BYTES
PART_BYTES = 40 << 20
TILE = (32, 2_048)  # bitmaps held against each other at once
FEW = 0.02  # of a tile's pairs, which are then compared singly
BLOCK_SETS = 256  # sets of a block in verification
MATRIX_BYTES = 4 << 20  # of bits in which sets are compared at once


def check_threshold(threshold: float) -> float:
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    return threshold


def shingle_frequencies(normalized: DataFrame, k: int) -> DataFrame:
    """``shingle, docs``: in how many documents each shingle occurs."""
    rows = normalized.select("doc_id", "normalized")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, docs in windows.set_counts(batch.column(0), k):
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(docs, pa.int64())], names=["shingle", "said"])

    short = short_texts(rows, k).select("normalized").mapInArrow(count, "shingle bigint, said bigint")
    long = set_rows(long_texts(rows, k).withColumn("row_no", F.monotonically_increasing_id()), k)
    long = long.select("shingle", F.lit(1).cast("bigint").alias("said"))
    return short.unionByName(long).groupBy("shingle").agg(F.sum("said").alias("docs"))


def sets_in(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: number of the first, their distinct shingles, each set sorted, and the sizes of the sets."""
    for i, j in windows.slices(texts):
        for a in range(i, j, TOGETHER):
            b = min(j, a + TOGETHER)
            yield a, *windows.distinct_sets(*windows.window_hashes(*windows.flat(texts.slice(a, b - a)), k))


def bucket_ranks(texts: DataFrame, k: int) -> np.ndarray:
    """Rank of each bucket of shingles by rising count over all ``texts(group_id, normalized)``.

    A frequent shingle makes its bucket frequent, so ordering shingles by it puts frequent ones last. Each task counts in
    a table of fixed size, and the sums come to the driver as one row per bucket, whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for i, j in windows.slices(batch.column(0)):
                found, _ = windows.window_hashes(*windows.flat(batch.column(0).slice(i, j - i)), k)
                counts += np.bincount(found & np.uint32((1 << BUCKET_BITS) - 1), minlength=1 << BUCKET_BITS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], names=["bucket", "said"])

    parts = texts.select("normalized").mapInArrow(count, "bucket int, said bigint")
    counted = parts.groupBy("bucket").agg(F.sum("said").alias("said")).toArrow()
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[counted["bucket"].to_numpy()] = counted["said"].to_numpy()
    ranks = np.empty(1 << BUCKET_BITS, np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(1 << BUCKET_BITS)
    return ranks


def sort_keys(shingles: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The rank of each shingle's bucket above the 32 bits of the shingle."""
    return (ranks[shingles & np.int64((1 << BUCKET_BITS) - 1)] << 32) | shingles


def prefix_length(size: int | np.ndarray, threshold: float) -> np.ndarray:
    return np.where(size > 0, size - np.ceil(threshold * size - SLACK).astype(np.int64) + 1, 0)


def telling(threshold: float) -> int:
    """The largest set of which a bitmap of ``PARITY_WORDS`` tells something."""
    return int(256 * PARITY_WORDS / (PARITY_ROOM * (1 + 1 / threshold) * (1 - threshold) / (1 + threshold) or 1e-3))


PREFIXES = "size bigint, last bigint, parity binary, prefix array<bigint>"


def id_kind(rows: DataFrame, name: str = "group_id") -> str:
    """Ids are of any type that has an order."""
    return rows.schema[name].dataType.simpleString()


def maybe_small(texts: pa.Array, k: int, most: int) -> pa.Array:
    """Which texts may have a set of at most ``most`` shingles: of a long text the beginning tells, but for repeats."""
    chars = 2 * most + k - 1
    long = np.flatnonzero(pc.greater(pc.utf8_length(texts), chars).fill_null(False).to_numpy(zero_copy_only=False))
    few = np.ones(len(texts), bool)
    for first, _, sizes in sets_in(pc.utf8_slice_codeunits(texts.take(pa.array(long)), 0, chars), k):
        few[long[first : first + len(sizes)]] = sizes <= most
    return pa.array(few)


def prefixes_of(
    texts: DataFrame, k: int, ranks: np.ndarray, threshold: float, most: int | None = None, wide: bool = True
) -> DataFrame:
    """``group_id, size, last, parity, prefix`` of texts whose set fits an array: its prefix as rising sort keys.

    With ``most``, sets of more shingles have no prefix, and a bitmap as wide as they want; if not ``wide``, they are left out.
    """
    shared = texts.sparkSession.sparkContext.broadcast(ranks)
    schema = f"group_id {id_kind(texts)}, {PREFIXES}"
    names = [part.split()[0] for part in schema.split(", ")]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            if not wide:
                batch = batch.filter(maybe_small(batch.column("normalized"), k, most))
            for first, flat, sizes in sets_in(batch.column("normalized"), k):
                ids = batch.column("group_id").slice(first, len(sizes))
                if not wide:
                    ids = ids.filter(pa.array(sizes <= most))
                    flat, sizes = flat[np.repeat(sizes <= most, sizes)], sizes[sizes <= most]
                owner = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
                key = sort_keys(flat, ranks).astype(np.uint64)
                ordered = np.sort((owner << np.uint64(32 + BUCKET_BITS)) | key)  # sets stay in their order
                ends = np.cumsum(sizes)
                keep = prefix_length(sizes, threshold)
                words = parity_words(sizes, threshold, PARITY_WORDS)
                if most is not None:
                    keep = np.where(sizes > most, 0, keep)
                    words = wide_words(sizes, threshold)
                place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
                chosen = ordered[place < np.repeat(keep, sizes)]
                prefix = (chosen & np.uint64((1 << (32 + BUCKET_BITS)) - 1)).astype(np.int64)
                parity = np.full(len(sizes), b"", object)
                for count in np.unique(words[words > 0]).tolist():
                    some = np.flatnonzero(words == count)
                    held = bitmaps(flat[np.repeat(words == count, sizes)], sizes[some], count)
                    parity[some] = [row.tobytes() for row in held]
                offsets = np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)
                last = np.where(keep > 0, prefix[np.maximum(offsets[1:] - 1, 0)] if len(prefix) else 0, 0)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(prefix))
                columns = [ids, pa.array(sizes.astype(np.int64)), pa.array(last), pa.array(parity, pa.binary()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts.select("group_id", "normalized").mapInArrow(make, schema)


def long_prefix_rows(rows: DataFrame, ranks: np.ndarray, threshold: float) -> DataFrame:
    """:func:`prefix_rows` of sets that come as durable ``rows(group_id, shingle)``: no array holds one of them."""
    shared = rows.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf("bigint")
    def key(batch: pa.Array) -> pa.Array:
        return pa.array(sort_keys(batch.to_numpy(zero_copy_only=False), shared.value))

    size = rows.groupBy("group_id").agg(F.count(F.lit(1)).alias("size"))
    order = Window.partitionBy("group_id").orderBy("sort_key")
    placed = rows.withColumn("sort_key", key("shingle")).withColumn("pos", (F.row_number().over(order) - 1).cast("int"))
    kept = placed.join(size, "group_id").filter(
        F.col("pos") < F.col("size") - F.ceil(F.col("size") * F.lit(threshold) - SLACK) + 1
    )
    last = kept.groupBy("group_id").agg(F.max("sort_key").alias("last"))
    parity = F.lit(b"").alias("parity")
    return kept.join(last, "group_id").select("group_id", "size", "last", parity, "pos", "sort_key")


def prefix_rows(texts: DataFrame, k: int, ranks: np.ndarray, threshold: float, long: DataFrame | None = None) -> DataFrame:
    """``group_id, size, last, parity, pos, sort_key``: one row per element of a prefix, ``last`` its end.

    ``long`` has the sets of the long texts as rows, if there are any.
    """
    rows = listed(prefixes_of(short_texts(texts, k), k, ranks, threshold))
    return rows if long is None else rows.unionByName(long_prefix_rows(long, ranks, threshold))


def listed(prefixes: DataFrame) -> DataFrame:
    """A row for each element of what :func:`prefixes_of` returns."""
    return prefixes.select("group_id", "size", "last", "parity", F.posexplode("prefix").alias("pos", "sort_key"))


def long_bitmaps(rows: DataFrame, threshold: float) -> DataFrame:
    """``group_id, size, parity`` of sets that come as durable ``rows(group_id, shingle)``: only the bitmap is ever in one place."""

    @F.arrow_udf("bigint")
    def width(size: pa.Array) -> pa.Array:
        return pa.array(wide_words(size.to_numpy(zero_copy_only=False), threshold))

    @F.arrow_udf("bigint")
    def place(shingle: pa.Array, words: pa.Array) -> pa.Array:
        return pa.array(bits(shingle.to_numpy(zero_copy_only=False), words.to_numpy(zero_copy_only=False)))

    def whole(table: pa.Table) -> pa.Table:
        words = table.column("words")[0].as_py()
        odd = np.zeros(words * 8, np.uint8)
        odd[table.column("byte").to_numpy()] = table.column("flips").to_numpy()
        row = table.select(["group_id", "size"]).slice(0, 1)
        return row.append_column("parity", pa.array([odd.tobytes()], pa.binary()))

    size = rows.groupBy("group_id").agg(F.count(F.lit(1)).alias("size")).withColumn("words", width("size"))
    placed = rows.join(size, "group_id").withColumn("bit", place("shingle", "words"))
    flip = F.call_function("shiftright", F.lit(128), (F.col("bit") % 8).cast("int"))  # the first bit of a byte is its highest
    flipped = placed.groupBy("group_id", "size", "words", F.expr("bit div 8").alias("byte")).agg(F.bit_xor(flip).alias("flips"))
    return flipped.groupBy("group_id").applyInArrow(whole, f"group_id {id_kind(rows)}, size bigint, parity binary")


def meetings(prefixes: DataFrame, threshold: float, list_rows: int | None = None) -> DataFrame:
    """``id1, id2, left, sizes`` for each element that two prefixes share, unless the two sets cannot be similar.

    Elements in one prefix only go first if the list of the others fits a broadcast; otherwise all travel, but once. A list of more than ``list_rows`` sets is cut into blocks and each two
    blocks meet in a place of their own. Rows of a list lie side by side in a task, which compares each with those behind it;
    ``left`` bounds what the sets can share beyond. ``prefixes`` is read several times: pass a durable table.
    """
    list_rows = LIST_ROWS if list_rows is None else list_rows
    counted = heavy_keys(prefixes, ["sort_key"], 1)
    if small(counted):
        parts = F.ceil(F.col("key_rows") / F.lit(list_rows)).cast("int").alias("parts")
        rows = prefixes.join(F.broadcast(counted.select("sort_key", parts)), "sort_key")
    else:
        rows = with_parts(prefixes, ["sort_key"], counted.filter(F.col("key_rows") > list_rows), list_rows)
    mine = F.pmod(F.xxhash64("group_id"), F.col("parts")).cast("int")
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = ["sort_key", "low", "high"]
    rows = rows.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    rows = rows.select(*cell, "mine", "group_id", "size", "last", "parity", "pos")
    dealt = rows.repartition(*cell).sortWithinPartitions(*cell)
    kind = id_kind(prefixes)
    schema = f"id1 {kind}, id2 {kind}, left bigint, sizes bigint"
    names = [part.split()[0] for part in schema.split(", ")]

    def pairs(table: pa.Table) -> pa.RecordBatch:
        """All pairs in whole lists."""
        key, low, high, mine, ids, size, last, pos = (
            table.column(c).to_numpy() for c in (*cell, "mine", "group_id", "size", "last", "pos")
        )
        words = pc.binary_length(table.column("parity")).to_numpy() // 8
        stored = np.zeros((len(ids), PARITY_WORDS), np.uint64)
        for count in np.unique(words[words > 0]).tolist():
            some = np.flatnonzero(words == count)
            joined = b"".join(table.column("parity").take(pa.array(some)).to_pylist())
            stored[some, :count] = np.frombuffer(joined, np.uint64).reshape(-1, count)
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        begins = np.flatnonzero(fresh)
        behind = np.repeat(np.append(begins[1:], len(ids)), np.diff(np.append(begins, len(ids))))
        found: list[list[np.ndarray]] = [[], [], [], []]
        x, ahead = np.arange(len(ids)), 0
        while len(x := x[x + (ahead := ahead + 1) < behind[x]]):
            y = x + ahead
            n1, n2, p1, p2 = size[x], size[y], pos[x], pos[y]
            needed = (n1 + n2) * (threshold / (1 + threshold) - SLACK)
            left = np.minimum(n1 - p1, n2 - p2) - 1
            keep = np.minimum(n1, n2) >= np.maximum(n1, n2) * threshold - SLACK
            keep &= np.minimum(p1, p2) + 1 + left >= needed
            keep &= (low[x] == high[x]) | (mine[x] != mine[y])  # those of one block meet among themselves
            a, b = x[keep], y[keep]
            both = np.minimum(words[a], words[b])
            for u, v in {*zip(words[a[both > 0]].tolist(), words[b[both > 0]].tolist(), strict=True)}:
                some = np.flatnonzero((words[a] == u) & (words[b] == v))
                apart = bits_apart(stored[a[some], :u], stored[b[some], :v])
                n = size[a[some]] + size[b[some]]
                far = n - apart < 2 * n * (threshold / (1 + threshold) - SLACK)
                a[some[far]] = -1
            a, b = a[a >= 0], b[a >= 0]
            ends_first = np.where(last[a] <= last[b], size[a], size[b])
            rest = np.ceil(ends_first * threshold - SLACK).astype(np.int64)  # beyond its prefix, and one for rounding
            left = np.minimum(np.minimum(size[a] - pos[a], size[b] - pos[b]) - 1, rest)
            made = [np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), left, size[a] + size[b]]
            for column, values in zip(found, made, strict=True):
                column.append(values)
        none = [ids[:0], ids[:0], size[:0], size[:0]]
        arrays = [np.concatenate([empty, *c]) for empty, c in zip(none, found, strict=True)]
        kinds = [table.schema.field("group_id").type] * 2 + [pa.int64()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(arrays, kinds, strict=True)], names=names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the list that the next batch may go on with
        for batch in batches:
            if not len(batch):
                continue
            whole = pa.Table.from_batches([*held, batch])
            ends = [whole.column(c)[len(whole) - 1].as_py() for c in cell]
            other = np.zeros(len(whole), bool)
            for c, end in zip(cell, ends, strict=True):
                other |= whole.column(c).to_numpy() != end
            cut = int(other.sum())  # rows are sorted: the last list is at the end
            if cut:
                yield pairs(whole.slice(0, cut))
            held = whole.slice(cut).to_batches()
        if held:
            yield pairs(pa.Table.from_batches(held))

    return dealt.mapInArrow(meet, schema)


def prefix_candidates(prefixes: DataFrame, threshold: float, list_rows: int | None = None) -> DataFrame:
    """``id1, id2`` of the sets that can still reach the threshold, given what their prefixes share.

    Let a pair share c prefix elements. Two bounds on its whole overlap follow. After the last shared element,
    r elements remain in the set where fewer remain: at most c + r. And in the set whose prefix ends first, every
    element of the prefix that is not shared is missing from the other set, since the other prefix reaches
    beyond it: at most c plus the rest of that set, which is ceil(t·n) − 1.
    """
    needed = F.col("sizes") * F.lit(threshold / (1 + threshold)) - SLACK * F.col("sizes")
    return (
        meetings(prefixes, threshold, list_rows)
        .groupBy("id1", "id2")
        .agg(
            F.count(F.lit(1)).alias("shared"),
            F.min("left").alias("left"),
            F.max("sizes").alias("sizes"),
        )
        .filter(F.col("shared") + F.col("left") >= needed)
        .select("id1", "id2")
    )


def size_classes(sets: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """``sets`` with the cells in which they are compared, ``low, gap, a, b, side``, a row for each, and how many cells there are.

    Sets that can be similar are in one class of sizes or at most ``CLASS_REACH`` classes apart. A cell with gap 1 holds a
    part of a class (side 0) against a part of those next above, and where ``b`` is 0 against itself; one with gap 0 holds
    two parts of a class. A class is one part unless its sets or their bitmaps are very many, so a bitmap travels
    ``1 + CLASS_REACH`` times at most.
    """
    step = max(1 / threshold, CLASS_STEP) ** (1 / CLASS_REACH) * (1 + 1e-6)  # a little more, for rounding
    sets = sets.withColumn("class", F.floor(F.log(F.col("size")) / F.lit(math.log(step))).cast("int"))
    counted = sets.groupBy("class").agg(F.count(F.lit(1)).alias("sets"), F.sum(F.octet_length("parity")).alias("held")).collect()
    highest = max((r["class"] for r in counted), default=0)
    parts = [0] * (highest + 1 + 2 * CLASS_REACH)  # that of class c is at c + CLASS_REACH
    for r in counted:
        some = max(min(CLASS_PARTS, math.ceil(r["sets"] / CLASS_SETS)), math.ceil(r["held"] / PART_BYTES))
        parts[r["class"] + CLASS_REACH] = some
    beyond = [max([1, *parts[i + 1 : i + 1 + CLASS_REACH]]) for i in range(len(parts))]  # parts of what lies above
    cells = sum(p * (p - 1) // 2 + p * above for p, above in zip(parts, beyond, strict=True))
    of, above = (F.array(*map(F.lit, counts)) for counts in (parts, beyond))
    dealt = F.xxhash64("group_id")
    mine = F.pmod(dealt, of[F.col("class") + CLASS_REACH]).cast("int")
    sets = sets.withColumn("mine", mine)

    def meets(count, cell, when=lambda i: F.lit(True)):
        return F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.when((i <= count) & when(i - 1), F.struct(*[
            value.cast("int").alias(name) for name, value in zip(("low", "gap", "a", "b", "side"), cell(i - 1), strict=True)
        ])))

    def below(low):
        at = low + CLASS_REACH
        return meets(of[at], lambda i: (low, one, i, F.pmod(dealt, above[at]), one))

    own, none, one = F.col("class"), F.lit(0), F.lit(1)
    part = F.col("mine")
    within = meets(
        of[own + CLASS_REACH], lambda i: (own, none, F.least(part, i), F.greatest(part, i), part > i), lambda i: part != i
    )
    up = meets(above[own + CLASS_REACH], lambda i: (own, one, part, i, none))
    down = [below(own - gap) for gap in range(1, CLASS_REACH + 1)]
    cell = F.explode(F.array_compact(F.concat(within, up, *down))).alias("cell")
    kept = [c for c in ("group_id", "size", "parity", "odd") if c in sets.columns]
    return sets.select(*kept, cell).select(*kept, "cell.*"), cells


def near_in_tiles(x: np.ndarray, y: np.ndarray, n1: np.ndarray, n2: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of bitmaps ``x`` and ``y`` of one width whose sets, of rising sizes ``n1`` and ``n2``, can be similar."""
    words = x.shape[1]
    columns = np.ascontiguousarray(y.T)
    rows, wide = TILE
    often = max(1, words // 8)
    for i in range(0, len(x), rows):
        tile, size = x[i : i + rows], n1[i : i + rows]
        first = np.searchsorted(n2, size[0] * threshold - SLACK)
        end = np.searchsorted(n2, size[-1] / threshold + 1, side="right")
        for j in range(int(first), int(end), wide):
            stop = min(int(end), j + wide)
            both = size[:, None] + n2[None, j:stop]
            room = both * (1 - 2 * (threshold / (1 + threshold) - SLACK))
            fits = np.minimum(size[:, None], n2[None, j:stop]) >= np.maximum(size[:, None], n2[None, j:stop]) * threshold - SLACK
            room = np.where(fits, np.floor(room), -1).astype(np.int32)
            apart = np.zeros(room.shape, np.int32)
            done = words
            for word in range(words):
                apart += np.bitwise_count(tile[:, word, None] ^ columns[word, None, j:stop])
                if word >= words // 4 and word % often == 0 and np.count_nonzero(apart <= room) <= FEW * room.size:
                    done = word + 1
                    break
            a, b = np.nonzero(apart <= room)
            if done < words:
                step = max(1, (1 << 20) // words)
                rest = [np.empty(0, np.int64)]
                for at in range(0, len(a), step):
                    rest.append(bits_apart(tile[a[at : at + step], done:], y[j + b[at : at + step], done:]))
                kept = apart[a, b] + np.concatenate(rest) <= room[a, b]
                a, b = a[kept], b[kept]
            yield a + i, b + j


def large_candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """``id1, id2`` of durable ``sets(group_id, size, parity)`` whose sizes and bitmaps allow the threshold.

    Every two sets of like size are compared, cell by cell; if there is a column ``odd``, only with sets that are.
    What is shuffled is each bitmap a few times.
    """
    kind = id_kind(sets)
    cell = ["low", "gap", "a", "b"]
    dealt, cells = size_classes(sets, threshold)
    names = ["id1", "id2"]

    def near(table: pa.Table) -> pa.Table:
        itself = table.column("gap")[0].as_py() == 1 and table.column("b")[0].as_py() == 0
        table = table.sort_by("size")
        ids, size, side = (table.column(c).to_numpy() for c in ("group_id", "size", "side"))
        odd = table.column("odd").to_numpy() if "odd" in table.column_names else np.ones(len(ids), bool)
        words = pc.binary_length(table.column("parity")).to_numpy() // 8
        held = {}
        for s in np.unique(side).tolist():
            for w in np.unique(words).tolist():
                for o in (False, True):
                    at = np.flatnonzero((side == s) & (words == w) & (odd == o))
                    joined = b"".join(table.column("parity").take(pa.array(at)).to_pylist())
                    held[s, w, o] = at, np.frombuffer(joined, np.uint64).reshape(len(at), w)
        found = [(ids[:0], ids[:0])]
        for (s, u, odd1), (at1, x) in held.items():
            for (other, v, odd2), (at2, y) in held.items():
                if s or not other and (not itself or (u, odd1) > (v, odd2)) or not len(at1) or not len(at2) or not odd1 | odd2:
                    continue
                least = min(u, v)
                for a, b in near_in_tiles(folded(x, least), folded(y, least), size[at1], size[at2], threshold):
                    if not other and (u, odd1) == (v, odd2):
                        a, b = a[a < b], b[a < b]
                    found.append((ids[at1[a]], ids[at2[b]]))
        one, two = (np.concatenate(c) for c in zip(*found, strict=True))
        made = [np.minimum(one, two), np.maximum(one, two)]
        return pa.table([pa.array(c, table.schema.field("group_id").type) for c in made], names=names)

    # so many partitions as cells, which are few bytes and much work
    dealt = dealt.repartition(max(1, min(cells, 10_000)), *cell)
    return dealt.groupBy(*cell).applyInArrow(near, f"id1 {kind}, id2 {kind}")


def shipments(wanted: DataFrame, texts: DataFrame, blocks: int) -> DataFrame:
    """The texts beside the cells that want them; a group is in no more cells than there are blocks."""
    texts = texts.hint("merge")  # the planner takes short texts for small and would broadcast them
    if blocks <= ARRAY_ROWS:
        return wanted.join(texts, "group_id")
    return salted_join(wanted, texts, ["group_id"], ARRAY_ROWS)


def dealt_blocks(pairs: DataFrame, block_sets: int) -> tuple[DataFrame, int]:
    """``group_id, block`` of all groups in ``pairs``, durable, and how many blocks there are.

    A group goes with the smallest group that it or one of its partners is paired with, so a cluster lies in one block,
    or in as many as its size asks for, and few of its pairs lie between two blocks.
    """
    ends = F.explode(F.array("id1", "id2")).alias("group_id")
    homes = durable(pairs.select(ends, "id1").groupBy("group_id").agg(F.min("id1").alias("home")), "homes")
    blocks = max(1, math.ceil(homes.count() / block_sets))
    parted = with_parts(homes, ["home"], heavy_keys(homes, ["home"], block_sets), block_sets)
    part = F.pmod(F.xxhash64("group_id"), F.col("parts"))
    block = F.pmod(F.xxhash64("home", part), F.lit(blocks)).cast("int").alias("block")
    placed = durable(parted.select("group_id", block), "placed")
    release(homes)
    return placed, blocks


def overlaps(flat: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many elements sets ``a`` and ``b`` share, for each pair; the sets lie one behind the other in ``flat``, each sorted.

    Elements of two sets and more become columns of a matrix of bits, which is made for some columns at a time.
    """
    shared = np.zeros(len(a), np.int64)
    used = np.unique(np.concatenate([a, b]))
    if not len(used):
        return shared
    row = np.full(len(sizes), -1)
    row[used] = np.arange(len(used))
    owner = np.repeat(row, sizes)
    kept = owner >= 0
    element, owner = flat[kept], owner[kept]
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    fresh = np.append(True, element[1:] != element[:-1])[: len(element)]
    common = ~(fresh & np.append(fresh[1:], True)[: len(element)])
    column = np.cumsum(fresh[common]) - 1
    owner = owner[common]
    wide = max(64, MATRIX_BYTES * 8 // len(used) // 64 * 64)
    same = a == b
    shared[same] = sizes[a[same]]
    a, b = row[a], row[b]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        i, j = np.searchsorted(column, (low, low + wide))
        words = (int(column[j - 1]) - low) // 64 + 1
        slot = owner[i:j] * (64 * words) + column[i:j] - low
        bit = np.zeros(len(used) * 64 * words, np.uint8)
        bit[slot] = 1
        held = np.packbits(bit).view(np.uint64).reshape(len(used), words)
        step = max(1, (1 << 20) // words)
        for at in range(0, len(a), step):
            both = held[a[at : at + step]] & held[b[at : at + step]]
            shared[at : at + step] += np.where(same[at : at + step], 0, np.bitwise_count(both).sum(axis=1, dtype=np.int64))
    return shared


def _verified_in_blocks(pairs: DataFrame, texts: DataFrame, k: int, block_sets: int, threshold: float) -> DataFrame:
    """``pairs`` with sizes and overlap, of groups whose sets fit an array each.

    Groups are dealt over blocks, and a text goes once to each two blocks that have a pair with it between them, however many
    such pairs there are; its set is made there. With a ``threshold`` above 0, pairs that bitmaps rule out are left out.
    """
    placed, blocks = dealt_blocks(pairs, block_sets)
    cell = ["low", "high"]
    beside = beside_pairs(pairs, placed, "block", over=None)
    dealt = beside.select(
        "id1", "id2", F.least("block1", "block2").alias("low"), F.greatest("block1", "block2").alias("high")
    )
    dealt = durable(dealt, "dealt")
    place = [F.col(c).alias(f"{c}_cell") for c in cell]
    wanted = dealt.select(*place, F.explode(F.array("id1", "id2")).alias("group_id")).distinct()
    own = lookup_semi(texts.select("group_id", "normalized"), placed.select("group_id"), ["group_id"])
    shipped = shipments(wanted, own, blocks)

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right.column("group_id").to_numpy()
        found = [(flat, sizes) for _, flat, sizes in sets_in(right.column("normalized").combine_chunks(), k)]
        flat, sizes = (np.concatenate([np.empty(0, np.int64), *c]) for c in zip(*found, strict=True))
        order = np.argsort(ids)
        id1, id2 = (left.column(c).to_numpy() for c in ("id1", "id2"))
        a, b = (order[np.searchsorted(ids[order], c)] for c in (id1, id2))
        if threshold and len(a):
            held = bitmaps(flat, sizes, CELL_WORDS)
            n = sizes[a] + sizes[b]
            kept = n - bits_apart(held[a], held[b]) >= 2 * n * (threshold / (1 + threshold) - SLACK)
            id1, id2, a, b = id1[kept], id2[kept], a[kept], b[kept]
        shared = overlaps(flat, sizes, a, b)
        kind = right.schema.field("group_id").type
        made = [pa.array(id1, kind), pa.array(id2, kind), *map(pa.array, (sizes[a], sizes[b], shared))]
        return pa.table(dict(zip(("id1", "id2", "size1", "size2", "shared"), made, strict=True)))

    both = dealt.groupBy(*cell).cogroup(shipped.groupBy("low_cell", "high_cell"))
    kind = id_kind(texts)
    schema = f"id1 {kind}, id2 {kind}, size1 bigint, size2 bigint, shared bigint"
    checked = durable(both.applyInArrow(check, schema), "verified")
    release(placed, dealt)
    return checked


def _verified_by_rows(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """``pairs`` with sizes and overlap, of groups some of which have more shingles than an array may hold."""
    ids = durable(pairs.select(F.explode(F.array("id1", "id2")).alias("group_id")).distinct(), "ids")
    rows = durable(set_rows(lookup_semi(texts.select("group_id", "normalized"), ids, ["group_id"]), k), "rows")
    sizes = rows.groupBy("group_id").agg(F.count(F.lit(1)).alias("size"))
    firsts = rows.withColumnRenamed("group_id", "id1").join(broadcast_if_small(durable(pairs, "pairs")), "id1")
    shared = firsts.join(rows.withColumnRenamed("group_id", "id2"), ["id2", "shingle"])
    shared = shared.groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("shared"))
    found = pairs.join(shared, ["id1", "id2"], "left")
    for i in ("1", "2"):
        found = found.join(sizes.select(F.col("group_id").alias(f"id{i}"), F.col("size").alias(f"size{i}")), f"id{i}", "left")
    filled = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("size1", "size2", "shared")]
    return durable(found.select("id1", "id2", *filled), "verified")


def verify(pairs: DataFrame, texts: DataFrame, k: int, threshold: float = 0.0, block_sets: int = BLOCK_SETS) -> DataFrame:
    """Add ``size1, size2, shared, jaccard`` to pairs of groups, from their whole shingle sets.

    Only the sets of documents that occur in a pair are built. Pairs with a long text are compared by rows. With a
    ``threshold`` some pairs below it are left out early. ``pairs`` and ``texts`` are read several times: pass durable tables.
    """
    long = long_texts(texts, k).select("group_id")
    if long.isEmpty():
        checked = _verified_in_blocks(pairs, texts, k, block_sets, threshold)
    else:
        marked, long = pairs, durable(long, "long")
        for i in ("1", "2"):
            names = broadcast_if_small(long).withColumnRenamed("group_id", f"id{i}").withColumn(f"long{i}", F.lit(True))
            marked = marked.join(names, f"id{i}", "left")
        marked = durable(marked.withColumn("by_rows", F.coalesce("long1", "long2", F.lit(False))), "marked")
        short = marked.filter("not by_rows").select("id1", "id2")
        checked = _verified_in_blocks(short, texts, k, block_sets, threshold)
        checked = checked.unionByName(_verified_by_rows(marked.filter("by_rows").select("id1", "id2"), texts, k))
    return checked.withColumn("jaccard", jaccard_of_counts(F.col("shared"), F.col("size1"), F.col("size2")))


def beside_odd(sets: DataFrame, odd: DataFrame, threshold: float) -> DataFrame:
    """Those of ``sets(group_id, size, parity)`` that some of ``odd``, of the same columns, may be similar to, and these, marked ``odd``."""
    scales = [r["scale"] for r in odd.select(F.floor(F.log2("size")).alias("scale")).distinct().collect()]
    near = F.lit(False)
    for scale in scales:
        near |= F.col("size").between(math.floor((1 << scale) * threshold * 0.99), math.ceil((4 << scale) / threshold))
    rest = sets.filter(near).join(broadcast_if_small(durable(odd.select("group_id"), "odd")), "group_id", "left_anti")
    return rest.withColumn("odd", F.lit(False)).unionByName(odd.withColumn("odd", F.lit(True)))


def similar_pairs(texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """All pairs of groups in ``texts(group_id, normalized)`` with Jaccard similarity of at least ``threshold``.

    ``id1 < id2, size1, size2, shared, jaccard``. Exact. ``texts`` should be durable.
    """
    check_threshold(threshold)
    most = telling(threshold)
    least = max(1, math.floor(most * threshold))  # two sets of which the smaller has fewer are both small
    tell = threshold >= LEAST_THRESHOLD
    short, long = short_texts(texts, k), long_texts(texts, k)
    ranks = bucket_ranks(texts.filter(F.length("normalized") - k + 1 <= most), k)
    sets = durable(prefixes_of(short, k, ranks, threshold, most, wide=not tell), "sets")
    prefixes, made, held = listed(sets), [sets], None
    if not long.isEmpty():
        long = durable(set_rows(long, k), "long")
        held = durable(long_bitmaps(long, threshold), "bitmaps")
        few = held.filter(F.col("size") <= most).select("group_id")
        prefixes = prefixes.unionByName(long_prefix_rows(long.join(few, "group_id", "left_semi"), ranks, threshold))
        made += [long, held]
        held = held.filter(F.col("size") >= least)
    prefixes = durable(prefixes, "prefixes")
    found = [durable(prefix_candidates(prefixes, threshold), "few")]  # one after the other: what each shuffles goes before the next
    release(prefixes)
    met = token_candidates(short, k, threshold, least) if tell else None
    odd = held  # sets that tokens cannot find
    if met is not None:
        found.append(met[0])
        made.append(met[1])
    if not tell or held is not None or met is not None and not met[1].isEmpty():
        if tell:
            sets = durable(prefixes_of(short.filter(F.length("normalized") - k + 1 >= least), k, ranks, threshold, most), "sets")
            made.append(sets)
        large = sets.filter(F.col("size") >= least).select("group_id", "size", "parity")
        if met is not None:
            weak = large.join(met[1], "group_id", "left_semi")
            odd = weak if odd is None else odd.unionByName(weak)
        if tell:
            large = durable(beside_odd(large, odd, threshold), "large")
            made.append(large)
        elif held is not None:
            large = large.unionByName(held)
        found.append(durable(large_candidates(large, threshold), "many"))
    release(*made)
    candidates = durable(functools.reduce(DataFrame.unionByName, found).distinct(), "candidates")
    release(*found)
    return verify(candidates, texts, k, threshold).filter(F.col("jaccard") >= threshold)
