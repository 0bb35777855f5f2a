"""Exact self-join of word n-gram sets by Jaccard similarity, skipping by set relations (Wang et al. 2017).

Documents with one and the same set are a class, and only classes are joined. All sets are sorted by one order
with rare shingles first, so two similar sets share a shingle among the first few of each, their prefixes.

Blocks: a set is cut by hash into one block more than two linked sets of its size can differ in shingles, so
linked sets agree on a whole block at the same place. Sets that agree with no other on any block are skipped before
any list is made; that leaves about the sets that have a near copy.

Index lists: one list per prefix shingle, in blocks of like-sized sets. A block whose sizes cannot match is never
met, and positions within the sets bound what two sets can still share. Beside each set goes a bitmap in which every
shingle flips one bit: as many bits as two bitmaps differ in, at least, the sets differ in shingles. Pairs that this rules out
never become rows. Long lists are met block against block.

Answers: in each list all sets are like the least one in it more often than not. Each set takes the one that
leads most of its lists as its pivot and is kept as its difference from the pivot, a few shingles. Sets with one
pivot are compared through their differences, in blocks of bounded size and without writing down a pair:
what a set shares with another is what the pivot has, less what either lacks, plus what both add. Only sets with
different pivots meet as pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm import texts
from sparkmine.llm.components import components
from sparkmine.llm.tables import Scratch

WORDS = 3
PERCENT = 90
BUCKET_BITS = 18  # shingles are counted in this many buckets, whatever their number
CHUNKS = 64
BAND_STEPS = 2  # how many steps of 100 / percent the sizes of sets with equally many blocks span
FILTER_BITS = 25  # of the fixed-size filter of classes that need their whole sets
BLOCK = 512  # sets of one pivot that are compared with as many others at once
TOGETHER = 4_096  # shingles of the differences looked at together
BROADCAST_BYTES = 2 << 20
SALT = 512  # sets of one pivot that one task holds against it
LEAD = 8  # parts in which the counts of a bucket are added up first
PARITY_WORDS = 8  # 64-bit words of a set's parity bitmap
LIST_ROWS = 1_000  # sets of one list that a task holds against as many others


def needed(sizes: Column | np.ndarray, percent: int) -> tuple:
    """Two sets are linked if (100 + percent) * shared >= percent * (their sizes added up): both factors' product."""
    return 100 + percent, percent * sizes


def set_digest(hashes: np.ndarray) -> bytes:
    """Names a set by its sorted distinct shingle hashes."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def mark_of(digest: bytes) -> int:
    """The beginning of a digest as a number."""
    return int.from_bytes(digest[:8], "big", signed=True)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _shingles(batch: pa.RecordBatch, k: int, weights: np.ndarray) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of rows with the distinct shingle hashes of each row, sorted."""
    for i, j in texts.slices(batch.column("text")):
        part = batch.slice(i, j - i)
        raw, offsets = texts.flat(part.column("text"))
        words, bounds = texts.word_hashes(raw, offsets, weights)
        hashes, ends = texts.shingle_hashes(words, bounds, k)
        yield part, [_distinct(hashes[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def least_size(percent: int) -> int:
    """Smaller sets equal what they are linked to."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def block_counts(n: int, percent: int) -> list[int]:
    """Into how many blocks a set of n shingles is cut; twice if it can be linked to one of the next size band."""
    ratio = (100 / percent) ** BAND_STEPS

    def begin(band: int) -> int:
        return math.ceil(ratio**band)

    band = int(math.log(n) / math.log(ratio))
    band += (begin(band + 1) <= n) - (begin(band) > n)  # rounding
    bands = [band, band + 1] if n * 100 // percent >= begin(band + 1) else [band]
    return sorted({2 * (begin(b + 1) - 1) * (100 - percent) // (100 + percent) + 1 for b in bands})


def block_names(values: np.ndarray, percent: int) -> np.ndarray:
    """A hash of each block of a set: how many there are, which it is, and what it holds."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(texts.mixed(values + np.uint64(1)))])
    out = []
    for m in block_counts(len(values), percent):
        place = ((values >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # rises with the sorted values
        ends = np.searchsorted(place, np.arange(m + 1, dtype=np.uint64))
        which = np.arange(m, dtype=np.uint64) + np.uint64(m << 32)
        out.append(texts.mixed((sums[ends[1:]] - sums[ends[:-1]]) ^ texts.mixed(which)))
    return np.concatenate(out)


def sketches(documents: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, digest, mark, blocks`` per row; and ``chunk, counts`` rows, parts of a table of counts.

    ``blocks`` names the blocks of a set that may be linked to an unequal one, once per set and task; ``mark`` is
    the beginning of the digest as a number. ``doc_id`` is a number, or binary if it is so in ``documents``.
    """
    binary = documents.schema["doc_id"].dataType.typeName() == "binary"
    weights = texts.byte_weights(texts.SPACES)
    names = ["doc_id", "n_shingles", "digest", "mark", "blocks", "chunk", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
    kinds[0] = pa.binary() if binary else kinds[0]
    least = least_size(percent)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        seen: set[bytes] = set()
        for whole in batches:
            for part, sets in _shingles(whole, k, weights):
                digests = [set_digest(s) for s in sets]
                blocks = []
                for values, digest in zip(sets, digests, strict=True):
                    np.add.at(counts, values & np.uint64((1 << BUCKET_BITS) - 1), 1)
                    fresh = len(values) >= least and digest not in seen
                    seen.add(digest)
                    blocks.append(block_names(values, percent).view(np.int64) if fresh else None)
                n = len(part)
                columns = [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([mark_of(d) for d in digests], pa.int64()),
                    pa.array(blocks, kinds[4]),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if counts.any():
            parts = [p.tobytes() for p in np.split(counts, CHUNKS)]
            columns = [*(pa.nulls(CHUNKS, t) for t in kinds[:5]), pa.array(range(CHUNKS), pa.int32()), pa.array(parts)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = "binary" if binary else "long"
    schema = f"doc_id {kind}, n_shingles long, digest binary, mark long, blocks array<long>, chunk int, counts binary"
    return documents.select(F.col("doc_id").cast(kind).alias("doc_id"), "text").mapInArrow(sketch, schema)


def bucket_ranks(sketched: DataFrame) -> np.ndarray:
    """Rank of each bucket by rising count. The table has a fixed size; its parts are added up in Spark."""

    def add(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()]
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([np.sum(rows, axis=0).tobytes()])})

    parts = sketched.filter("chunk is not null").select("chunk", "counts")
    lead = F.pmod(F.xxhash64("counts"), F.lit(LEAD)).alias("lead")
    once = parts.groupBy("chunk", lead).applyInArrow(add, "chunk int, counts binary")
    total = once.groupBy("chunk").applyInArrow(add, "chunk int, counts binary")
    counts = np.zeros((CHUNKS, (1 << BUCKET_BITS) // CHUNKS), np.int64)
    for row in total.collect():
        counts[row.chunk] = np.frombuffer(row.counts, np.int64)
    ranks = np.empty(1 << BUCKET_BITS, np.uint64)
    ranks[np.argsort(counts.ravel(), kind="stable")] = np.arange(1 << BUCKET_BITS, dtype=np.uint64)
    return ranks


def ordered_keys(values: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The shingles renamed one to one as signed numbers, which sort by rank of the bucket."""
    bucket = values & np.uint64((1 << BUCKET_BITS) - 1)
    named = (ranks[bucket] << np.uint64(64 - BUCKET_BITS)) | (values >> np.uint64(BUCKET_BITS))
    return np.sort((named ^ np.uint64(1 << 63)).view(np.int64))


def parity(values: np.ndarray) -> np.ndarray:
    """A bitmap of ``PARITY_WORDS`` signed words in which each shingle flips one bit."""
    slots = (values >> np.uint64(BUCKET_BITS)) & np.uint64(64 * PARITY_WORDS - 1)
    odd = np.bincount(slots.astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def keyed(documents: DataFrame, k: int, ranks: np.ndarray, wanted: np.ndarray, percent: int | None = None) -> DataFrame:
    """``digest, n, keys, parity``, once per set whose mark passes the filter ``wanted``: its shingles in the common order.

    With ``percent`` only the prefix: the first n - ceil(n * percent / 100) + 1; without, ``parity`` is null.
    """
    weights = texts.byte_weights(texts.SPACES)
    shared = documents.sparkSession.sparkContext.broadcast((ranks, wanted))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, wanted = shared.value
        for whole in batches:
            for _, sets in _shingles(whole, k, weights):
                digests, sizes, keys, odd = [], [], [], []
                for values in sets:
                    digest = set_digest(values)
                    slot = mark_of(digest) & ((1 << FILTER_BITS) - 1)
                    n = len(values)
                    if n and wanted[slot >> 5] >> (slot & 31) & 1:
                        named = ordered_keys(values, ranks)
                        digests.append(digest)
                        sizes.append(n)
                        keys.append(named if percent is None else named[: n + (-n * percent) // 100 + 1])
                        odd.append(None if percent is None else parity(values))
                if digests:
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))
                    columns = [pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), lists]
                    columns.append(pa.array(odd, pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names=["digest", "n", "keys", "parity"])

    rows = documents.select("text").mapInArrow(key, "digest binary, n int, keys array<long>, parity array<long>")
    return rows.dropDuplicates(["digest"])


def mark_column(digest: str = "digest") -> Column:
    """:func:`mark_of` as a column."""
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


def mark_filter(marks: DataFrame) -> np.ndarray:
    """A bitmap of 2**FILTER_BITS bits by the last bits of ``marks(mark)``; its size does not depend on them."""
    slot = F.col("mark").bitwiseAND((1 << FILTER_BITS) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(31).cast("int"))
    rows = (
        marks.select(F.shiftright(slot, 5).alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (FILTER_BITS - 5), np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out


def if_small(scratch: Scratch, name: str, table: DataFrame) -> DataFrame:
    """``table``, written as ``name``, marked for broadcasting if its files are small."""
    return F.broadcast(table) if scratch.bytes(name) <= BROADCAST_BYTES else table


def pivots_of(met: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """``digest, pivot`` for each set in ``met(key, digest, ...)``: the set that leads most of its lists.

    Leaders are the least of their lists, so pointers go down; they are doubled until none moves, so every pivot
    is its own pivot and among the sets that are compared through it. A set that shares less than a quarter of its
    prefix with its leader has met it by chance and stays its own pivot. Any choice like that gives the right links.
    """
    leaders = scratch.write("leaders", met.groupBy("key").agg(F.min("digest").alias("leader")), ("met",))
    led = (
        met.select("key", "digest", "n")
        .join(if_small(scratch, "leaders", leaders), "key")
        .filter("leader <> digest")
        .groupBy("digest", "leader", "n")
        .count()
        .filter(F.col("count") * 4 >= F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + 1)
    )
    best = led.groupBy("digest").agg(F.min(F.struct(-F.col("count"), "leader"))["leader"].alias("pivot"))
    current = scratch.write("pivots_0", best, ("met",))
    scratch.drop("leaders")
    step, moved = 0, True
    while moved:
        step += 1
        ahead = current.select(F.col("digest").alias("pivot"), F.col("pivot").alias("next"))
        jumped = current.join(ahead, "pivot", "left")
        jumped = jumped.select("digest", F.coalesce("next", "pivot").alias("pivot"), F.isnotnull("next").alias("moved"))
        current = scratch.write(f"pivots_{step}", jumped, (f"pivots_{step - 1}",))
        scratch.drop(f"pivots_{step - 1}")
        moved = not current.filter("moved").isEmpty()
        current = current.drop("moved")
    every = met.select("digest").distinct().join(current, "digest", "left")
    return every.select("digest", F.coalesce("pivot", "digest").alias("pivot"))


def linked(n: np.ndarray, m: np.ndarray, shared: np.ndarray, percent: int) -> np.ndarray:
    return (100 + percent) * shared >= percent * (n[:, None] + m[None, :])


def common_counts(flat: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """How many elements each two of ``count`` sets share."""
    _, number, seen = np.unique(flat, return_inverse=True, return_counts=True)
    often = seen[number] > 1
    number, owner = number[often], owner[often]
    _, number = np.unique(number, return_inverse=True)
    total = np.zeros((count, count), np.float32)
    for begin in range(0, int(number.max(initial=-1)) + 1, TOGETHER):
        some = (number >= begin) & (number < begin + TOGETHER)
        rows, columns = owner[some], number[some] - begin
        held = np.zeros((count, int(columns.max(initial=0)) + 1), np.float32)
        held[rows, columns] = 1
        total += held @ held.T
    return total.astype(np.int64)


def least_linked(links: np.ndarray) -> np.ndarray:
    """Number of the first member of each member's component."""
    label = np.arange(len(links))
    for i in range(len(links)):
        if label[i] != i:
            continue
        front = np.array([i])
        while len(front):
            reached = np.flatnonzero(links[front].any(axis=0) & (label > i))
            label[reached] = i
            front = reached
    return label


def differences(sets: DataFrame) -> DataFrame:
    """``digest, pivot, n, copies, pivot_n, lacking, changed`` of ``sets(digest, pivot, n, copies, keys, salts)``.

    ``changed`` has the shingles by which a set differs from its pivot, ``lacking`` how many of them the pivot has.
    Sets are dealt by pivot and salt, each part with a copy of the pivot, and streamed past it.
    """
    order = ["pivot", "salt", "lead"]
    member = sets.withColumn("salt", F.pmod(F.xxhash64("digest"), F.col("salts")).cast("int")).withColumn("lead", F.lit(1))
    leads = sets.filter("digest = pivot").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    both = member.unionByName(leads.withColumn("lead", F.lit(0))).select(*order, "digest", "n", "copies", "keys")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["digest", "pivot", "n", "copies", "pivot_n", "lacking", "changed"]
        kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
        base, held = np.empty(0, np.int64), None
        for batch in batches:
            ends = np.concatenate([[0], np.cumsum(batch.column("keys").value_lengths().to_numpy())])
            flat = batch.column("keys").flatten().to_numpy()
            out: list[list] = [[] for _ in names]
            columns = zip(*(batch.column(c).to_pylist() for c in ("lead", "digest", "pivot", "n", "copies")), strict=True)
            for i, (lead, digest, pivot, n, copies) in enumerate(columns):
                keys = flat[ends[i] : ends[i + 1]]
                if lead == 0:
                    base, held = keys, pivot
                    continue
                if pivot != held:
                    raise ValueError("a pivot is not among its own sets")
                gone = np.setdiff1d(base, keys, assume_unique=True)
                come = np.setdiff1d(keys, base, assume_unique=True)
                row = [digest, pivot, n, copies, len(base), len(gone), np.concatenate([gone, come])]
                for values, value in zip(out, row, strict=True):
                    values.append(value)
            if out[0]:
                made = [pa.array(c, type=t) for c, t in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(made, names=names)

    dealt = both.repartition("pivot", "salt").sortWithinPartitions(*order)
    schema = "digest binary, pivot binary, n int, copies long, pivot_n int, lacking int, changed array<long>"
    return dealt.mapInArrow(compare, schema)


def answers_by_pivot(diffs: DataFrame, scratch: Scratch, percent: int, block: int) -> DataFrame:
    """``digest, root, links`` from the differences of sets that have a pivot in common.

    One row per set and block in which it was compared: the least set that it reaches by links
    there, and the documents that it is linked to there.
    """
    sizes = diffs.groupBy("pivot").count().filter(F.col("count") > block)
    sizes = sizes.select("pivot", F.ceil(F.col("count") / F.lit(block)).cast("int").alias("blocks"))
    sizes = if_small(scratch, "sizes", scratch.write("sizes", sizes, ("diffs",)))
    mine = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    dealt = (
        diffs.join(sizes, "pivot", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "pivot",
            F.least("mine", "other").alias("low"),
            F.greatest("mine", "other").alias("high"),
            "mine",
            *["digest", "n", "copies", "pivot_n", "lacking", "changed"],
        )
        .repartition("pivot", "low", "high")  # else all blocks of a pivot would stay in its task
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("digest")
        n, copies, pivot_n, lacking, mine = (
            table.column(c).to_numpy() for c in ("n", "copies", "pivot_n", "lacking", "mine")
        )
        lists = table.column("changed").combine_chunks()
        owner = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy())
        both = common_counts(lists.flatten().to_numpy(), owner, len(n))
        shared = pivot_n[0] - lacking[:, None] - lacking[None, :] + both
        links = linked(n.astype(np.int64), n.astype(np.int64), shared, percent)
        np.fill_diagonal(links, False)
        if table.column("low")[0] != table.column("high")[0]:
            links &= mine[:, None] != mine[None, :]  # those of one block meet among themselves
        label = least_linked(links)
        digests = table.column("digest")
        return pa.table(
            {"digest": digests, "root": digests.take(pa.array(label)), "links": pa.array(links @ copies.astype(np.int64))}
        )

    found = dealt.groupBy("pivot", "low", "high").applyInArrow(compare, "digest binary, root binary, links long")
    return found.filter("links > 0")


def meetings(rows: DataFrame, scratch: Scratch, percent: int, list_rows: int = LIST_ROWS) -> DataFrame:
    """``d1, d2, left, bound`` for each two sets of ``rows`` with different pivots in a list, unless they cannot be linked.

    A list is cut into bands by size, in each of which the greatest set is at most 100 / percent times the least, so a
    set meets its own band and the next. The position of the common shingle bounds the overlap, and so does the number of
    bits in which the parity bitmaps differ. A list of more than ``list_rows`` sets is cut into blocks, and each
    two blocks meet in a task of their own.
    """
    steps = F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent))
    band = F.floor(steps + F.lit(1e-9)).cast("int")  # exact powers must not fall short by rounding
    long = rows.groupBy("key").count().filter(F.col("count") > list_rows)
    long = long.select("key", F.ceil(F.col("count") / F.lit(list_rows)).cast("int").alias("parts"))
    long = if_small(scratch, "long", scratch.write("long", long, ("lists",)))
    rows = rows.join(long, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("band", band)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    x = rows.withColumn("met", F.explode(F.array("band", F.col("band") + 1)))
    x = x.withColumn("at_x", F.col("mine")).withColumn("at_y", others).alias("x")
    y = rows.withColumn("met", F.col("band")).withColumn("at_y", F.col("mine")).withColumn("at_x", others).alias("y")
    n1, n2, p1, p2 = F.col("x.n"), F.col("y.n"), F.col("x.pos"), F.col("y.pos")
    most = F.least(p1, p2) + 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    factor, bound = needed(n1 + n2, percent)
    once = F.when(F.col("x.band") == F.col("y.band"), F.col("x.digest") < F.col("y.digest")).otherwise(F.lit(True))
    on = once
    for column in ("key", "met", "at_x", "at_y"):
        on &= F.col(f"x.{column}") == F.col(f"y.{column}")
    on &= (F.col("x.pivot") != F.col("y.pivot")) & (most * factor >= bound)
    on &= F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent
    apart: Column = F.lit(0)
    for i in range(PARITY_WORDS):
        apart = apart + F.bit_count(F.col(f"x.odd{i}").bitwiseXOR(F.col(f"y.odd{i}")))
    on &= (n1 + n2 - apart) * factor >= 2 * bound
    ends_first = F.when(F.col("x.last") <= F.col("y.last"), n1).otherwise(n2)
    rest = F.ceil(ends_first * F.lit(percent) / F.lit(100)) - 1  # beyond its prefix
    return x.join(y, on).select(
        F.least("x.digest", "y.digest").alias("d1"),
        F.greatest("x.digest", "y.digest").alias("d2"),
        F.least(n1 - p1 - 1, n2 - p2 - 1, rest).alias("left"),
        bound.alias("bound"),
    )


def pairs_across(met: DataFrame, pivots: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """``d1, d2``: pairs of sets with different pivots that sizes, positions and parity bitmaps do not rule out.

    Over all lists in which two sets meet, two more bounds follow: after the last common shingle of the prefixes, no
    more can be shared than either set has left; and in the set whose prefix ends first, what is not common in the
    prefix is missing from the other set.
    """
    rows = met.join(if_small(scratch, "pivots", pivots), "digest")
    mixed = rows.groupBy("key").agg(F.min("pivot").alias("a"), F.max("pivot").alias("b")).filter("a <> b")
    mixed = scratch.write("mixed", mixed.select("key"), ("met", "pivots"))
    rows = scratch.write("lists", rows.join(if_small(scratch, "mixed", mixed), "key", "left_semi"), ("met", "pivots"))
    found = meetings(rows, scratch, percent).groupBy("d1", "d2", "bound")
    found = found.agg(F.count(F.lit(1)).alias("shared"), F.min("left").alias("left"))
    return found.filter((F.col("shared") + F.col("left")) * (100 + percent) >= F.col("bound")).select("d1", "d2")


def set_links(documents: DataFrame, k: int, percent: int, scratch: Scratch, block: int = BLOCK) -> tuple[DataFrame, ...]:
    """Three frames: ``doc_id, n_shingles, digest`` of all rows, class ``digest, copies, first_id``, and links.

    Links are ``digest, root, links`` rows between classes; a class may have several: they name sets that it
    is connected to and add up to the documents of other classes that it is linked to.
    """
    sketched = scratch.write("sketched", sketches(documents, k, percent))
    rows = scratch.write("rows", sketched.filter("chunk is null").select("doc_id", "n_shingles", "digest"))
    ranks = bucket_ranks(sketched)
    classes = scratch.write(
        "classes",
        rows.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")),
        ("rows",),
    )
    blocks = sketched.filter("blocks is not null").select("mark", F.explode("blocks").alias("block"))
    common = scratch.write("common", blocks.groupBy("block").count().filter("count > 1").select("block"), ("sketched",))
    agreeing = scratch.write("agreeing", blocks.join(common, "block", "left_semi").select("mark").distinct(), ("sketched",))
    scratch.drop("sketched", "common")

    prefixes = scratch.write("prefixes", keyed(documents, k, ranks, mark_filter(agreeing), percent))
    last = F.element_at("keys", -1).alias("last")
    odd = [F.col("parity")[i].alias(f"odd{i}") for i in range(PARITY_WORDS)]
    postings = prefixes.select("digest", "n", *odd, last, F.posexplode("keys").alias("pos", "key"))
    repeated = scratch.write("repeated", postings.groupBy("key").count().filter("count > 1").select("key"), ("prefixes",))
    met = scratch.write("met", postings.join(if_small(scratch, "repeated", repeated), "key", "left_semi"), ("prefixes",))
    scratch.drop("agreeing", "prefixes", "repeated")
    pivots = scratch.write("pivots", pivots_of(met, scratch, percent), ("met",))
    pairs = scratch.write("pairs", pairs_across(met, pivots, scratch, percent))
    scratch.drop("met", "lists", "mixed", "long")

    around = pivots.groupBy("pivot").count().filter("count > 1")
    around = around.select("pivot", F.ceil(F.col("count") / F.lit(SALT)).cast("int").alias("salts"))
    grouped = pivots.join(around, "pivot")
    paired = pairs.select(F.explode(F.array("d1", "d2")).alias("digest")).distinct().withColumn("paired", F.lit(True))
    needed_sets = grouped.join(paired, "digest", "full").join(classes.select("digest", "copies"), "digest")
    needed_sets = scratch.write("needed", needed_sets, ("pivots", "pairs", "classes"))
    wanted = mark_filter(needed_sets.select(mark_column().alias("mark")))
    sets = scratch.write("sets", keyed(documents, k, ranks, wanted).join(needed_sets, "digest"))
    scratch.drop("needed")

    diffs = scratch.write("diffs", differences(sets.filter("pivot is not null")))
    inside = scratch.write("inside", answers_by_pivot(diffs, scratch, percent, block))
    scratch.drop("diffs", "sizes")

    def side(i: int) -> DataFrame:
        columns = ["digest", "n", "copies", "keys"]
        named = sets.filter("paired").select(*[F.col(c).alias(f"{'d' if c == 'digest' else c}{i}") for c in columns])
        return named.hint("merge")

    factor, bound = needed(F.col("n1") + F.col("n2"), percent)
    shared = F.size(F.array_intersect("keys1", "keys2"))
    met_pairs = pairs.join(side(1), "d1").join(side(2), "d2").filter(shared * factor >= bound)
    verified = scratch.write("verified", met_pairs.select("d1", "d2", "copies1", "copies2"))
    scratch.drop("sets", "pairs")
    across = verified.select(F.col("d1").alias("digest"), F.col("d1").alias("root"), F.col("copies2").alias("links"))
    across = across.unionByName(
        verified.select(F.col("d2").alias("digest"), F.col("d1").alias("root"), F.col("copies1").alias("links"))
    )
    return rows, classes, inside.unionByName(across)


def near_duplicates(documents: DataFrame, k: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Per row of ``documents(doc_id, text)``: doc_id, n_shingles, component_id, n_links.

    Two documents are linked if 100 times what their sets share is at least ``percent`` times their union.
    ``component_id`` is the least doc_id reachable by links, ``n_links`` the number of linked rows. A text of
    fewer than k words has one shingle, its whole sequence. Null and empty texts have none, are linked with
    nothing and are their own component. Repeated rows are documents of their own that are linked with each other.
    A null doc_id is never a component's name unless no member has another. Ids are numbers, or binary keys that
    sort byte by byte. Other columns are ignored.
    """
    scratch = Scratch(documents.sparkSession)
    rows, classes, links = set_links(documents, k, percent, scratch, block)
    links = scratch.write("links", links, ("inside", "verified"))
    roots = components(links.select(F.col("digest").alias("u"), F.col("root").alias("v")), scratch)
    counts = links.groupBy("digest").agg(F.sum("links").alias("links"))
    named = (
        classes.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
        .join(counts, "digest", "left")
        .withColumn("root", F.coalesce("root", "digest"))
    )
    named = scratch.write("named", named, ("classes", "links"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answer = named.join(least, "root").select(
        "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return rows.join(answer, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
