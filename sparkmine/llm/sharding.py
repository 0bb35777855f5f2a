"""Shards of nearly equal bytes by longest-processing-time scheduling (Graham 1969).

Rows of equal text form a group that stays together. Groups go from large to small, each to the shard
with the least load so far. The driver plans with a histogram of group sizes, not with the groups:
groups of one size are interchangeable, so a plan says how many of each size a shard gets, and Spark
deals them out by their position in the order. Sizes of 1,024 bytes and more are kept to ten leading
bits, so the histogram has at most some 30,000 rows at any input size.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.tables import Scratch
from sparkmine.operators.order import number_rows
from sparkmine.operators.skew import salted_join

LEADING_BITS = 10
ONE_BY_ONE = 64  # groups of one size dealt singly; of more, the even part is dealt at once


def size_class(size: Column) -> Column:
    """``size`` with all but its leading bits cleared."""
    shift = F.greatest(F.length(F.bin(size)) - LEADING_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)


def level_counts(loads: Sequence[float], count: int, size: float) -> list[int]:
    """How many of ``count`` groups of ``size`` each shard surely gets when all are filled evenly."""
    low, high = min(loads), max(loads) + count * size
    for _ in range(100):
        mid = (low + high) / 2
        if sum(max(0, int((mid - load) // size)) for load in loads) <= count:
            low = mid
        else:
            high = mid
    return [max(0, int((low - load) // size)) for load in loads]


def schedule(histogram: Sequence[tuple[int, int, int]], shards: int) -> dict[int, tuple[int, list[int]]]:
    """Plan for ``(class, groups, bytes)``: class -> position of its first group, groups per shard summed up."""
    loads = [0.0] * shards
    plan, position = {}, 0
    for kind, count, total in sorted(histogram, reverse=True):
        size = total / count
        taken = level_counts(loads, count, size) if count > ONE_BY_ONE else [0] * shards
        heap = [(loads[i] + taken[i] * size, i) for i in range(shards)]
        heapq.heapify(heap)
        for _ in range(count - sum(taken)):
            load, i = heap[0]
            taken[i] += 1
            heapq.heapreplace(heap, (load + size, i))
        for load, i in heap:
            loads[i] = load
        plan[kind] = (position, [sum(taken[: i + 1]) for i in range(shards)])
        position += count
    return plan


def shard(documents: DataFrame, shards: int = 16) -> DataFrame:
    """Per row of ``documents(doc_id, text)``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size: UTF-8 bytes of the text plus 1; a null text has no bytes, CRC 0 and forms a group of its own,
    unlike the empty text. Slots count each shard's rows from 0 in order of doc_id. Repeated rows keep a
    slot each. Law ``bytes``; ``grown_shard`` is null under it. Other columns are ignored.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    spark = documents.sparkSession
    scratch = Scratch(spark)
    text = F.col("text")
    rows = scratch.write(
        "rows",
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("digest"),
        ),
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    ordered = number_rows(groups.withColumn("class", -size_class(F.col("bytes"))), ["class", "digest"], "position")
    histogram = ordered.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).collect()
    plan = schedule([(-r["class"], r.n, r.b) for r in histogram], shards)
    table = spark.createDataFrame(
        [(-kind, start, ends) for kind, (start, ends) in plan.items()],
        "class long, start long, ends array<long>",
    )
    place = F.col("position") - 1 - F.col("start")
    dealt = ordered.join(F.broadcast(table), "class").select(
        "digest", F.size(F.filter("ends", lambda end: end <= place)).alias("shard")
    )
    placed = scratch.write("placed", salted_join(rows, dealt, ["digest"]).drop("digest"))  # a text may be in many rows
    counts = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    starts = [sum(counts.get(s, 0) for s in range(i)) for i in range(shards)]
    numbered = number_rows(placed, ["shard", "doc_id", "size", "text_crc32"], "n")
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("n") - 1 - F.get(F.lit(starts).cast("array<bigint>"), F.col("shard"))).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
