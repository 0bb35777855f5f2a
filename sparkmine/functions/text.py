"""Normalised text and character shingles."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.functions import windows

PIECE_CHARS = 1 << 20  # shingles of a longer text are never in one array

# Fixed values. What is deleted: anything but letters, numerics, underscore and white space.
# What is collapsed: Unicode white space and the four separators U+001C to U+001F.
NOT_WORD_OR_SPACE = r"(?U)[^\p{L}\p{N}_\s\x{1c}-\x{1f}]"
SPACE_RUN = r"(?U)[\s\x{1c}-\x{1f}]+"


def normalize_text(text: Column) -> Column:
    """Lower case, word characters and single blanks only, no blanks at the ends."""
    words = F.regexp_replace(F.lower(text), NOT_WORD_OR_SPACE, "")
    return F.trim(F.regexp_replace(words, SPACE_RUN, " "))


def check_k(k: int) -> int:
    if k <= 0:
        raise ValueError("shingle length k must be positive")
    return k


def shingles(normalized: Column, k: int) -> Column:
    """All k-character substrings in order, repeats kept; empty if the text is shorter than k.

    One regular-expression pass: an empty match at each character captures the k characters ahead.
    The first look-ahead skips the middle of a surrogate pair.
    """
    ahead = r"(?s)(?=[^\x{DC00}-\x{DFFF}])(?=(.{%d}))" % check_k(k)
    return F.regexp_extract_all(normalized, F.lit(ahead), F.lit(1))


def shingle_hashes(normalized: Column, k: int) -> Column:
    """CRC-32 (unsigned, as bigint) of each shingle, repeats kept."""
    return _hashes(normalized, check_k(k), False)


def shingle_set(normalized: Column, k: int) -> Column:
    """Distinct shingle hashes, sorted. Made within the row: the text never has to be shuffled for it."""
    return _hashes(normalized, check_k(k), True)


def set_summary(normalized: Column, k: int) -> Column:
    """``n, least, greatest, total`` of the distinct shingle hashes, of which no list is made; null where there are none."""
    check_k(k)

    @F.arrow_udf("n bigint, least bigint, greatest bigint, total bigint")
    def summary(batch: pa.Array) -> pa.Array:
        return windows.set_summaries(batch, k)

    return summary(normalized)


def _hashes(normalized: Column, k: int, distinct: bool) -> Column:
    @F.arrow_udf("array<bigint>")
    def hashes(batch: pa.Array) -> pa.Array:
        return windows.hash_lists(batch, k, distinct)

    return hashes(normalized)


def pieces(rows: DataFrame, k: int, chars: int | None = None) -> DataFrame:
    """Cut ``normalized`` into pieces with ``chars`` shingles each, and add ``pieces``, how many the text has.

    Pieces overlap by k - 1 characters, so every shingle of the text is in one piece and no other is.
    """
    chars = PIECE_CHARS if chars is None else chars
    count = F.greatest(F.ceil((F.length("normalized") - check_k(k) + 1) / F.lit(chars)), F.lit(1)).cast("int")
    cut = rows.withColumn("pieces", count).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    part = F.substring("normalized", F.col("piece") * chars + 1, F.lit(chars + k - 1))
    return cut.withColumn("normalized", F.when(F.col("pieces") == 1, F.col("normalized")).otherwise(part)).drop("piece")


def text_key(normalized: Column, k: int) -> Column:
    """SHA-256 of the normalised text; one common key for all texts too short to have a shingle.

    Two texts with one key have the same shingle set.
    """
    short = F.length(normalized) < check_k(k)
    digest = F.unhex(F.sha2(F.when(short, F.lit("")).otherwise(normalized), 256))
    # never null: otherwise a join would test the key for null below the projection, computing it twice
    return F.coalesce(digest, F.lit(b""))
