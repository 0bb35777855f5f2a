"""Text files: labelled texts, baskets, edge lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmine.operators.storage import broadcast_if_small, durable

# Unicode white space and the four separators, alone and at the ends of a line.
BLANKS = r"(?U)[\s\x{1c}-\x{1f}]+"
END_BLANKS = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"

PREFIX = "sms_"  # fixed value: what document ids begin with

ARRIVAL_ORDER = ["file_time", "file_path", "block_start"]  # of the splits of a file stream
LINE_ORDER = ["file_path", "block_start", "line_no"]  # a total order: file, split, line in the split


def strip(line: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.regexp_replace(line, END_BLANKS, "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line``, stripped, with the columns of :data:`LINE_ORDER`."""
    return spark.read.schema("value string").text(path).select(
        strip(F.col("value")).alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
    )


def number_lines(accepted: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """Number lines 1, 2, 3 … in file order, without sorting or moving them.

    ``accepted`` are filtered lines of :func:`read_lines`. A split's lines lie next to each other in one
    partition, so a line's place in its split is the difference of two running ids; the splits are counted, one
    row each, and their offsets added.
    The query fails if the files are split otherwise when it runs.
    """
    split = LINE_ORDER[:2]
    marked = accepted.withColumn("mark", F.monotonically_increasing_id())
    counted = marked.groupBy(*split).agg(F.min("mark").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = F.sum("lines").over(Window.orderBy(*split)) - F.col("lines")
    splits = durable(counted.withColumn("before", before).drop("lines"), "splits")
    place = F.col("mark") - F.col("first") + F.col("before") + 1
    moved = F.raise_error(F.lit("the files were split otherwise when their lines were counted"))
    numbered = marked.join(broadcast_if_small(splits), split, "left").withColumn(
        name, F.coalesce(place, moved.cast("bigint"))
    )
    if limit is not None:
        numbered = numbered.filter(F.col(name) <= limit)
    return numbered.drop("mark", "first", "before")


def labelled_text(
    spark: SparkSession, path: str, limit: int | None = None, prefix: str = PREFIX
) -> DataFrame:
    """``n, doc_id, label, text`` from lines of a label, a tab and a text.

    Lines without a tab or without text are skipped; the others are numbered in file order, and
    ``limit`` keeps the first ones. The text may hold further tabs and quotes.
    """
    lines = read_lines(spark, path)
    parts = F.split(F.col("line"), "\t", 2)
    accepted = (
        lines.filter(F.size(parts) == 2)
        .select(parts[0].alias("label"), parts[1].alias("text"), *LINE_ORDER)
        .filter(strip(F.col("text")) != "")
    )
    numbered = number_lines(accepted, "n", limit)
    return numbered.select("n", F.concat(F.lit(prefix), F.col("n")).alias("doc_id"), "label", "text")


def basket_lines(spark: SparkSession, path: str) -> DataFrame:
    """``tid, items`` from lines of blank-separated items: sorted, without repeats.

    Blank lines are skipped; ``tid`` numbers the others in file order.
    """
    lines = read_lines(spark, path).filter(F.col("line") != "")
    items = F.sort_array(F.array_distinct(F.split(F.col("line"), BLANKS)))
    return number_lines(lines.select(items.alias("items"), *LINE_ORDER), "tid").select("tid", "items")


def edge_lines(spark: SparkSession, path: str, skip_bad: bool = False) -> DataFrame:
    """``u, v`` and the line order, from lines that begin with two whole numbers.

    Lines that begin with ``#`` and lines of one token are skipped, further tokens are ignored.
    A token that is no number fails the query, or with ``skip_bad`` drops the line.
    Self-loops stay; :func:`sparkmine.operators.edges.canonical_edges` drops them.
    """
    return _edges_of(read_lines(spark, path), LINE_ORDER, skip_bad)


def _edges_of(lines: DataFrame, order: list[str], skip_bad: bool) -> DataFrame:
    """``u, v`` and ``order`` of the lines that are edges."""
    tokens = F.split(F.col("line"), BLANKS)
    pairs = lines.filter(~F.col("line").startswith("#")).filter(F.size(tokens) >= 2)
    pairs = pairs.select(tokens[0].alias("u"), tokens[1].alias("v"), *order)
    if skip_bad:
        ends = [F.col(c).try_cast("bigint").alias(c) for c in ("u", "v")]
        return pairs.select(*ends, *order).dropna(subset=["u", "v"])
    ends = [F.col(c).cast("bigint").alias(c) for c in ("u", "v")]
    return pairs.select(*ends, *order)


def edge_line_stream(spark: SparkSession, path: str, skip_bad: bool = False, files: int | None = None) -> DataFrame:
    """A stream of ``u, v`` and :data:`ARRIVAL_ORDER` from files as :func:`edge_lines` reads them, as they come.

    ``files`` is how many of them a micro-batch takes at most. A stream cannot number lines; rows of a micro-batch lie in the
    order of their lines within each split.
    """
    reader = spark.readStream.schema("value string")
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    lines = reader.text(path).select(
        strip(F.col("value")).alias("line"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    return _edges_of(lines, ARRIVAL_ORDER, skip_bad)


def preview(numbered: DataFrame, rows: int = 5, name: str = "t") -> DataFrame:
    """The first rows of a numbered stream."""
    return numbered.filter(F.col(name) <= rows).orderBy(name)
