"""Documents, groups of equal texts, and their shingle sets.

Documents whose normalised texts are equal have equal shingle sets, so they form one *group*, named by
its smallest document id and weighted by its number of ``copies``. Pairs are then formed between
groups only: a text copied into a third of all rows costs one row per copy, not one row per pair of
copies. Nothing is lost: two documents are similar if they are in one group, or if their groups are.

Texts are normalised once and written; the text of each group is written once more, by itself, and all
further steps read that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions import text
from sparkmine.functions.text import normalize_text, pieces, set_summary, shingle_set, text_key
from sparkmine.operators.skew import ARRAY_ROWS, lookup_semi, salted_join

EMPTIES = ("match", "drop")


def normalized_documents(
    docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text", empties: str = "match"
) -> DataFrame:
    """``doc_id, normalized, text_key``. Rows without text are skipped.

    Texts shorter than ``k`` have no shingles. With ``empties="match"`` they are all alike and form
    one group; with ``"drop"`` they are left out.
    """
    if empties not in EMPTIES:
        raise ValueError(f"empties must be one of {EMPTIES}")
    clean = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), normalize_text(F.col(text_col)).alias("normalized")
    )
    if empties == "drop":
        clean = clean.filter(F.length("normalized") >= k)
    return clean.withColumn("text_key", text_key(F.col("normalized"), k))


def copy_groups(normalized: DataFrame) -> DataFrame:
    """``text_key, group_id, copies``: one row per distinct text. No text is shuffled."""
    return normalized.groupBy("text_key").agg(
        F.min("doc_id").alias("group_id"), F.count(F.lit(1)).alias("copies")
    )


def group_members(normalized: DataFrame, groups: DataFrame) -> DataFrame:
    """``doc_id, group_id, copies`` for every document."""
    keyed = normalized.select("doc_id", "text_key")
    return salted_join(keyed, groups, ["text_key"]).select("doc_id", "group_id", "copies")


def group_texts(normalized: DataFrame, groups: DataFrame) -> DataFrame:
    """``group_id, normalized``: the text of each group, from written tables of both."""
    ids = groups.select(F.col("group_id").alias("doc_id"))
    return lookup_semi(normalized.select("doc_id", "normalized"), ids, ["doc_id"]).select(
        F.col("doc_id").alias("group_id"), "normalized"
    )


def long_texts(texts: DataFrame, k: int) -> DataFrame:
    """Those of ``texts(..., normalized)`` whose shingles are more than one array may hold."""
    return texts.filter(F.length("normalized") - k + 1 > text.PIECE_CHARS)


def short_texts(texts: DataFrame, k: int) -> DataFrame:
    """The others."""
    return texts.filter(F.length("normalized") - k + 1 <= text.PIECE_CHARS)


def set_rows(texts: DataFrame, k: int) -> DataFrame:
    """One row per distinct ``shingle`` of each of ``texts``, whose other columns stay and name it.

    For texts of any length: a piece gives an array of its own shingles, and rows that several pieces share are
    made one by a shuffle on all columns, so a single text is spread over many tasks.
    """
    named = [c for c in texts.columns if c != "normalized"]
    found = pieces(texts, k).select(*named, F.explode(shingle_set(F.col("normalized"), k)).alias("shingle"))
    return found.distinct()


def set_statistics(normalized: DataFrame, k: int) -> DataFrame:
    """``doc_id, n_chars, n_shingles, min_hash, max_hash, sum_hash`` of ``normalized(doc_id, normalized)``.

    The last three are null for a text without shingles.
    """
    rows = normalized.select("doc_id", F.length("normalized").alias("n_chars"), "normalized")
    short = short_texts(rows, k).withColumn("set", set_summary(F.col("normalized"), k))
    short = short.select(
        "doc_id",
        "n_chars",
        F.col("set.n").alias("n_shingles"),
        F.col("set.least").alias("min_hash"),
        F.col("set.greatest").alias("max_hash"),
        F.col("set.total").alias("sum_hash"),
    )
    long = set_rows(long_texts(rows, k).withColumn("row_no", F.monotonically_increasing_id()), k)
    long = long.groupBy("doc_id", "n_chars", "row_no").agg(
        F.count(F.lit(1)).alias("n_shingles"),
        F.min("shingle").alias("min_hash"),
        F.max("shingle").alias("max_hash"),
        F.sum("shingle").alias("sum_hash"),
    )
    return short.unionByName(long.drop("row_no"))


def beside_pairs(pairs: DataFrame, values: DataFrame, *names: str, over: int = ARRAY_ROWS) -> DataFrame:
    """``pairs(id1, id2, ...)`` with ``names`` of ``values(group_id, ...)`` for both sides, as name1 and name2.

    A group that is in many pairs is salted.
    """
    for i in ("1", "2"):
        side = values.select(F.col("group_id").alias(f"id{i}"), *[F.col(n).alias(n + i) for n in names])
        # the planner takes arrays for small and would broadcast them
        pairs = salted_join(pairs, side.hint("merge"), [f"id{i}"], over)
    return pairs


def with_copies(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Add ``copies1, copies2`` to pairs of groups."""
    return beside_pairs(pairs, groups, "copies", over=None)
