"""Small tables with everything that an operator must bear: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

WORDS = "the of and to in a is that for it as was with be by on not he this are or his from at which but".split()


def documents(spark, rows):
    """``rows`` of (doc_id, text), with further columns whose names an operator might use itself."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = "label score digest keys n pos key root links size shard words token_ids row_key marks n_tokens".split()
    return frame.withColumns({c: F.lit("x") for c in [*clashing, "lang", "source"]}).withColumn("n_chars", F.lit(None))


def sentence(rng: random.Random, count: int, words=WORDS) -> str:
    return " ".join(rng.choice(words) for _ in range(count))


def changed(rng: random.Random, text: str, edits: int) -> str:
    parts = text.split(" ")
    for _ in range(edits):
        parts[rng.randrange(len(parts))] = f"w{rng.randrange(10_000)}"
    return " ".join(parts)


ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "Two Words",
    "two\twords",
    "İstanbul ÉCOLE ß 漢字 😀 ¼   non-breaking",
    "x" * 70_000,
    "a b " * 9_000,
    "\x00 nul and \x7f control",
]
