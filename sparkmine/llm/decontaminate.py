"""Benchmark decontamination by winnowing (Schleimer, Wilkerson and Aiken 2003).

Of every ``window`` consecutive words, the least of its k-gram hashes is kept. Two texts that share
``window`` words keep the same fingerprint inside them, so a join on fingerprints meets every shared
window, and comparing the words around a meeting tells how far it extends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkmine.llm import texts
from sparkmine.llm.tables import Scratch
from sparkmine.operators.skew import ARRAY_ROWS, salted_join

WINDOW = 13
K = 5
SLOTS = 1 << 24  # of the fixed-size filter of benchmark fingerprints
BROADCAST_BYTES = 8 << 20
MISSING = {"doc": 1, "item": 2}  # stands for words beyond a text's ends; unequal on the two sides

MARKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("words", T.IntegerType()),
            T.StructField("pos", T.IntegerType()),
            T.StructField("print", T.LongType()),
            T.StructField("around", T.ArrayType(T.LongType())),
        ]
    )
)


def winnowed(hashes: np.ndarray, valid: np.ndarray, width: int) -> np.ndarray:
    """Positions whose hash is the least of some ``width`` consecutive ones (ties: all of them)."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    h = np.where(valid, hashes, most)
    least = h.copy()
    for i in range(1, width):
        np.minimum(least[: len(h) - i], h[i:], out=least[: len(h) - i])
    least[len(h) - width + 1 :] = 0  # no whole window begins here
    best = least.copy()
    for i in range(1, width):
        np.maximum(best[i:], least[: len(h) - i], out=best[i:])
    return np.flatnonzero((best == h) & valid)


def marks_of(
    words: np.ndarray,
    bounds: np.ndarray,
    window: int,
    k: int,
    shorts: list[int] | None,
    side: str,
    wanted: np.ndarray | None,
) -> pa.Array:
    """The fingerprints of each text with the words around them, as an array of ``MARKS``.

    On the side of the items (``shorts`` is None) a text below ``window`` words has one mark, its whole
    sequence. On the side of the documents all runs of the lengths ``shorts`` are looked at, and only
    marks whose slot is in ``wanted`` are returned.
    """
    counts = np.diff(bounds)
    ends = np.repeat(bounds[1:], counts)
    begins = np.repeat(bounds[:-1], counts)
    at = np.arange(len(words))
    long = ends - begins >= window
    parts = []
    gram = texts.grams(words, k)
    parts.append((0, winnowed(gram, (at + k <= ends) & long, window - k + 1), gram))
    for m in range(1, window) if shorts is None else shorts:
        if shorts is None and not (counts == m).any():
            continue
        run = texts.grams(words, m) + np.uint64(m)
        fits = (at == begins) & (ends - begins == m) if shorts is None else at + m <= ends
        parts.append((m, np.flatnonzero(fits), run))
    found = []
    for m, positions, hashes in parts:
        prints = hashes[positions]
        if wanted is not None:
            slot = prints & np.uint64(SLOTS - 1)
            kept = (wanted[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
            positions, prints = positions[kept], prints[kept]
        found.append((np.full(len(positions), m, np.int32), positions, prints))
    size, place, prints = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(place, kind="stable")
    size, place, prints = size[order], place[order], prints[order]
    reach = window - k
    around = place[:, None] + np.arange(-reach, k + reach)[None, :]
    inside = (around >= begins[place][:, None]) & (around < ends[place][:, None])
    inside &= (size == 0)[:, None]
    near = np.where(inside, words[np.clip(around, 0, max(len(words) - 1, 0))], np.uint64(MISSING[side]))
    near_offsets = np.arange(len(place) + 1, dtype=np.int32) * np.int32(k + 2 * reach)
    record = pa.StructArray.from_arrays(
        [
            pa.array(size),
            pa.array((place - begins[place]).astype(np.int32)),
            pa.array(prints.view(np.int64)),
            pa.ListArray.from_arrays(pa.array(near_offsets), pa.array(near.ravel().view(np.int64))),
        ],
        names=["words", "pos", "print", "around"],
    )
    offsets = np.searchsorted(place, bounds).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), record)


def marked(
    table: DataFrame, key: str, window: int, k: int, shorts: list[int] | None, wanted: np.ndarray | None
) -> DataFrame:
    """``key, row_key, n_words, marks``: one row per row of ``table(key, text)``."""
    side = "item" if shorts is None else "doc"
    weights = texts.byte_weights(texts.NON_WORD)
    bits = table.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i, j in texts.slices(whole.column("text")):
                batch = whole.slice(i, j - i)
                raw, offsets = texts.flat(batch.column("text"))
                words, bounds = texts.word_hashes(raw, offsets, weights)
                filled = bits.value if bits is not None else None
                marks = marks_of(words, bounds, window, k, shorts, side, filled)
                names = [str(x).encode() for x in batch.column(key).to_pylist()]
                keys = [
                    hashlib.blake2b(name + b"\0" + raw[a:b].tobytes(), digest_size=16).digest()
                    for name, a, b in zip(names, offsets[:-1], offsets[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key),
                        pa.array(keys, pa.binary()),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        marks,
                    ],
                    names=[key, "row_key", "n_words", "marks"],
                )

    schema = T.StructType(
        [
            table.schema[key],
            T.StructField("row_key", T.BinaryType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("marks", MARKS),
        ]
    )
    return table.select(key, "text").mapInArrow(mark, schema)


def filter_bits(prints: DataFrame) -> np.ndarray:
    """A bitmap of ``SLOTS`` bits with the slots of all fingerprints; its size does not depend on them."""
    slot = F.col("print").bitwiseAND(SLOTS - 1)
    octets = (
        prints.select(
            F.shiftright(slot, 3).alias("octet"),
            F.call_function("shiftleft", F.lit(1), slot.bitwiseAND(7).cast("int")).alias("bit"),
        )
        .groupBy("octet")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(SLOTS >> 3, np.uint8)
    out[octets["octet"].to_numpy()] = octets["bits"].to_numpy().astype(np.uint8)
    return out


def _run(equal: list[Column]) -> Column:
    """How many of the conditions hold before the first that does not."""
    count: Column = F.lit(0)
    for condition in reversed(equal):
        count = F.when(condition, count + 1).otherwise(F.lit(0))
    return count


def hits(documents: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW, k: int = K):
    """Two frames: ``doc_id, row_key, n_words`` of every document row, and its hits.

    Hits are ``row_key, item_id, begin, end``: words begin to end - 1 of the row are a run that occurs
    in the item and holds a window of it.
    """
    items = marked(benchmark.select("item_id", "text").dropna(subset=["item_id"]), "item_id", window, k, None, None)
    items = scratch.write(
        "items", items.select("item_id", F.explode("marks").alias("m")).select("item_id", "m.*").distinct()
    )
    shorts = sorted(r.words for r in items.filter("words > 0").select("words").distinct().collect())
    wanted = filter_bits(items)
    rows = scratch.write("marked", marked(documents, "doc_id", window, k, shorts, wanted))
    met = rows.select("row_key", F.explode("marks").alias("m")).select("row_key", "m.*")
    small = scratch.bytes("items") <= BROADCAST_BYTES
    other = items.withColumnRenamed("around", "item_around").drop("pos")
    # A passage may be in a large share of the documents.
    key = ["words", "print"]
    both = met.join(F.broadcast(other), key) if small else salted_join(met, other.hint("merge"), key, ARRAY_ROWS)
    reach = window - k
    same = [F.col("around")[i] == F.col("item_around")[i] for i in range(2 * reach + k)]
    core = F.lit(True)
    for condition in same[reach : reach + k]:
        core = core & condition
    whole = F.col("words") > 0
    left = F.when(whole, 0).otherwise(_run(same[:reach][::-1]))
    right = F.when(whole, F.col("words")).otherwise(k + _run(same[reach + k :]))
    found = (
        both.withColumn("core", whole | core)
        .withColumn("left", left)
        .withColumn("right", right)
        .filter(F.col("core") & (whole | (F.col("left") + F.col("right") >= window)))
        .select(
            "row_key",
            F.col("item_id").cast("string").alias("item_id"),
            (F.col("pos") - F.col("left")).alias("begin"),
            (F.col("pos") + F.col("right")).alias("end"),
        )
    )
    return rows.select("doc_id", "row_key", "n_words"), found


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, share: int = 20
) -> DataFrame:
    """Per row of ``documents(doc_id, text)``: how much of it occurs in ``benchmark(item_id, text)``.

    Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated. A word is hit if it lies in an
    occurrence of a window, that is ``window`` consecutive words of an item or a whole shorter item;
    a row is contaminated if at least one in ``share`` words is hit. Null and empty texts have no words
    and are clean; items without an id take no part; repeated rows get a result each; other columns are
    ignored.
    """
    scratch = Scratch(documents.sparkSession)
    rows, found = hits(documents, benchmark, scratch, window, k)
    before = Window.partitionBy("row_key").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        found.groupBy("row_key", "begin", "end")
        .agg(F.collect_set("item_id").alias("some"))
        .withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("row_key")
        .agg(
            F.sum(F.greatest(F.col("end") - F.greatest("begin", "reached"), F.lit(0))).alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("some")))).alias("items"),
        )
    )
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return rows.join(covered, "row_key", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
