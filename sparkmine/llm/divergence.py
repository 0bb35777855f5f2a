"""Divergence of a source's vocabulary from its language and from the other sources of the language, in whole numbers.

Counting: the terms of a run of texts are packed by length. A term of up to 8 bytes is one uint64 word, one of up to 16
two; terms that need as many 16-bit digits lie in one bucket, which a radix sort orders digit by digit, and equal
neighbours are counted as runs. Longer terms lie in buckets of equal length and are sorted as bytes. Zero is no
byte of a term, so padding tells terms of unlike length apart.

Comparing: a language's kept terms are dealt over cells by hash, its sources over blocks. Within a cell, two blocks are
compared as dense tables; terms that no source of the two blocks holds add the same value each and are added at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.llm import texts
from sparkmine.llm.tables import Scratch
from sparkmine.operators.skew import lookup_join

LEAST_DOCUMENTS = 3
SCALE_STEPS = 3  # steps of 1,000: shares are of 1,000,000,000
RANKS = 200
RUN_BYTES = 4 << 20  # bytes of text counted together; a longer text is cut at separators
PACKED = 16  # terms of more bytes are long
CELL_ROWS = 1 << 14  # counts of a language in one cell, about
BLOCK = 64  # sources compared with as many others at once
SLICE = 1 << 12  # terms in a dense table

# Bytes outside terms. All are ASCII, so working on bytes gives the same terms as on characters.
OUTSIDE = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
COUNTED = "lang string, source string, term string, count long, docs long"


def lower_table() -> np.ndarray:
    """Each byte with A-Z lower-cased and 0 for those outside terms."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[list(OUTSIDE)] = 0
    return table


def runs(order: np.ndarray, columns: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """First row of each run of equal ``columns`` taken in ``order``, its length and its number of documents.

    Within a run the documents must rise.
    """
    fresh = np.ones(len(order), bool)
    for i, column in enumerate(columns):
        differs = column[order[1:]] != column[order[:-1]]
        fresh[1:] = differs if not i else fresh[1:] | differs
    begins = np.flatnonzero(fresh)
    new_doc = fresh.copy()
    new_doc[1:] |= docs[order[1:]] != docs[order[:-1]]
    return order[begins], np.diff(begins, append=len(order)), np.add.reduceat(new_doc, begins, dtype=np.int64)


def radix_order(words: list[np.ndarray], digits: int, groups: np.ndarray, group_count: int) -> np.ndarray:
    """Stable order by group, then by the leading ``digits`` 16-bit digits of the packed words.

    Least digit first; numpy sorts 16-bit numbers stably by radix.
    """
    order = np.arange(len(groups))
    for digit in range(digits - 1, -1, -1):
        word = words[digit // 4]
        low = (word >> np.uint64(48 - 16 * (digit % 4))).astype(np.uint16)
        order = order[np.argsort(low[order], kind="stable")]
    for shift in range(0, max(1, (group_count - 1).bit_length()), 16):
        order = order[np.argsort((groups >> shift).astype(np.uint16)[order], kind="stable")]
    return order


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, count: int) -> list[np.ndarray]:
    """``count`` uint64 words per term, its bytes from the most significant on, zero beyond its end.

    ``data`` has 16 bytes of padding.
    """
    out = []
    for k in range(count):
        word = np.zeros(len(starts), np.uint64)
        for i in range(8 * k, 8 * k + 8):
            byte = data[starts + np.minimum(i, lengths)].astype(np.uint64)
            byte[lengths <= i] = 0
            word = (word << np.uint64(8)) | byte
        out.append(word)
    return out


def count_terms(
    raw: np.ndarray, offsets: np.ndarray, groups: np.ndarray, group_count: int, table: np.ndarray
) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """Group, term, occurrences and documents of all texts in ``raw``, one bucket of lengths after another.

    Text i, ``raw[offsets[i] : offsets[i + 1]]``, belongs to ``groups[i]``.
    """
    data = np.concatenate([table[raw], np.zeros(PACKED, np.uint8)])
    inside = data != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1][offsets[1:-1] < len(raw)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    docs = np.searchsorted(offsets, starts, side="right") - 1
    group = groups[docs]
    digits = (lengths + 1) // 2
    for bucket in range(1, PACKED // 2 + 1):
        some = np.flatnonzero(digits == bucket)
        if not len(some):
            continue
        words = packed(data, starts[some], lengths[some], 1 if bucket <= 4 else 2)
        order = radix_order(words, bucket, group[some], group_count)
        at, counts, held = runs(order, [*words, group[some]], docs[some])
        yield group[some][at], terms_at(data, starts[some][at], lengths[some][at]), counts, held
    for length in np.unique(lengths[lengths > PACKED]).tolist():
        some = np.flatnonzero(lengths == length)
        bytes_of = np.lib.stride_tricks.sliding_window_view(data, length)[starts[some]]
        whole = np.ascontiguousarray(bytes_of).view(f"S{length}").ravel()
        order = np.argsort(whole, kind="stable")
        order = order[np.argsort(group[some][order], kind="stable")]
        at, counts, held = runs(order, [whole, group[some]], docs[some])
        yield group[some][at], terms_at(data, starts[some][at], lengths[some][at]), counts, held


def terms_at(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The terms as strings."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    flat = data[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat))


def pieces(raw: np.ndarray, table: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """``raw`` cut at bytes outside terms into pieces of about ``size`` bytes."""
    begin = 0
    while begin < len(raw):
        end = min(begin + size, len(raw))
        while end < len(raw) and not len(gaps := np.flatnonzero(table[raw[begin:end]] == 0)):
            end = min(end + size, len(raw))  # a term longer than the piece
        if end < len(raw):
            end = begin + int(gaps[-1]) + 1
        yield raw[begin:end]
        begin = end


def group_counts(documents: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """``lang, source, term, count, docs`` of ``documents(text, lang, source)``: occurrences, and documents with the term.

    A row with a null term stands for each group of a run of texts, so that groups without terms are known.
    """
    table = lower_table()
    names = ["lang", "source", "term", "count", "docs"]

    def batch(groups: list[tuple[str, str]], group: np.ndarray, terms: pa.Array, counts, docs) -> pa.RecordBatch:
        lang, source = (pa.array([g[i] for g in groups]).take(pa.array(group)) for i in (0, 1))
        columns = [lang, source, terms.cast(pa.string()), pa.array(counts), pa.array(docs)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def one_long(raw: np.ndarray, group: tuple[str, str]) -> Iterator[pa.RecordBatch]:
        """Counts of a text beyond a run, piece by piece; each of its terms has one document."""
        total: dict[str, int] = {}
        for piece in pieces(raw, table, run_bytes):
            ends = np.array([0, len(piece)])
            for _, terms, counts, _ in count_terms(piece, ends, np.zeros(1, np.int64), 1, table):
                for term, count in zip(terms.to_pylist(), counts.tolist(), strict=True):
                    total[term] = total.get(term, 0) + count
        terms, counts = pa.array(list(total), pa.string()), np.array(list(total.values()), np.int64)
        yield batch([group], np.zeros(len(total), np.int64), terms, counts, np.ones(len(total), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i, j in texts.slices(whole.column("text"), run_bytes):
                part = whole.slice(i, j - i)
                pairs = list(zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True))
                number = {pair: n for n, pair in enumerate(dict.fromkeys(pairs))}
                groups = list(number)
                seen = np.arange(len(groups))
                zeros = np.zeros(len(groups), np.int64)
                yield batch(groups, seen, pa.nulls(len(groups), pa.string()), zeros, zeros)
                raw, offsets = texts.flat(part.column("text"))
                if len(raw) > 2 * run_bytes:  # a single text
                    yield from one_long(raw, groups[0])
                    continue
                belongs = np.array([number[pair] for pair in pairs], np.int64)
                for group, terms, counts, docs in count_terms(raw, offsets, belongs, len(groups), table):
                    yield batch(groups, group, terms, counts, docs)

    said = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    partial = documents.select(*said).mapInArrow(run, COUNTED)
    return partial.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1,000,000,000 * (count + 1) / (total + kept)) exactly, by long division in steps of 1,000."""
    by = total + kept
    rest, out = count + 1, F.lit(0).cast("long")
    for _ in range(SCALE_STEPS):
        out = out * 1000 + F.call_function("div", rest * 1000, by)
        rest = F.pmod(rest * 1000, by)
    return out + 1


def shares(counts: np.ndarray, totals: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """:func:`share` of arrays."""
    by = totals + kept
    rest, out = counts + 1, np.zeros_like(counts)
    for _ in range(SCALE_STEPS):
        more, rest = np.divmod(rest * 1000, by)
        out = out * 1000 + more
    return out + 1


def gain(p: Column, q: Column) -> Column:
    """floor((p - q) * (p - q) / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def pair_values(counts: DataFrame, groups: DataFrame, scratch: Scratch, cell_rows: int, block: int) -> DataFrame:
    """``lang, source, item, value`` for each two sources of a language, both ways.

    ``counts`` has lang, source, term and count of kept terms, ``groups`` lang, source, rows, total and kept of each group.
    """
    langs = (
        groups.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("sources"), F.sum("rows").alias("rows"))
        .select(
            "lang",
            F.ceil(F.col("sources") / F.lit(block)).cast("int").alias("blocks"),
            F.ceil(F.col("rows") / F.lit(cell_rows)).cast("int").alias("cells"),
        )
    )
    cut = scratch.write("cut", langs.filter("cells > 0"))
    held = lookup_join(counts.select("lang", "source", "term", "count"), cut, ["lang"])
    held = held.withColumn("cell", F.pmod(F.xxhash64("term"), F.col("cells")).cast("int"))
    marks = groups.join(cut, "lang").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    marks = marks.withColumn("term", F.lit(None).cast("string"))
    columns = ["lang", "source", "term", "count", "total", "kept", "blocks", "cell"]
    none = F.lit(None).cast("long")
    both = held.withColumns({"total": none, "kept": none}).select(*columns)
    both = both.unionByName(marks.withColumn("count", none).select(*columns))
    mine = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    both = both.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = both.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})

    def compare(table: pa.Table) -> pa.Table:
        marked = table.filter(pa.compute.is_null(table.column("term"))).sort_by("source")
        names = marked.column("source").combine_chunks()
        total, kept, mine = (marked.column(c).to_numpy() for c in ("total", "kept", "mine"))
        rows = table.filter(pa.compute.is_valid(table.column("term")))
        coded = rows.column("term").combine_chunks().dictionary_encode()
        term = coded.indices.to_numpy(zero_copy_only=False)
        at = pa.compute.index_in(rows.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False)
        said = rows.column("count").to_numpy()
        size, terms = len(names), len(coded.dictionary)
        value = np.zeros((size, size), np.int64)
        order = np.argsort(term, kind="stable")
        cuts = np.searchsorted(term[order], np.arange(0, terms + SLICE, SLICE))
        for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            here = order[a:b]
            dense = np.zeros((size, min(SLICE, terms - n * SLICE)), np.int64)
            dense[at[here], term[here] - n * SLICE] = said[here]
            p = shares(dense, total[:, None], kept[:, None])
            for i in range(size):
                value[i] += ((p[i] - p) ** 2 // p).sum(axis=1)
        apart = ~np.eye(size, dtype=bool)
        if table.column("low")[0] != table.column("high")[0]:
            apart &= mine[:, None] != mine[None, :]  # those of one block meet among themselves
        first, second = np.nonzero(apart)
        lang = pa.array([table.column("lang")[0].as_py()] * len(first), pa.string())
        columns = {"lang": lang, "source": names.take(pa.array(first)), "item": names.take(pa.array(second))}
        return pa.table(columns | {"part": pa.array(value[apart]), "covered": pa.array(np.full(len(first), terms))})

    schema = "lang string, source string, item string, part long, covered long"
    met = both.groupBy("lang", "low", "high", "cell").applyInArrow(compare, schema)
    met = met.groupBy("lang", "source", "item").agg(F.sum("part").alias("part"), F.sum("covered").alias("covered"))
    pairs = groups.select("lang", "source", "kept", F.col("total").alias("n1"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("n2"))
    pairs = pairs.join(others, "lang").filter("source <> item")  # the rows of the result
    nothing = F.lit(0).cast("long")
    p, q = share(nothing, F.col("n1"), F.col("kept")), share(nothing, F.col("n2"), F.col("kept"))
    absent = F.when(F.col("kept") > 0, (F.col("kept") - F.coalesce("covered", nothing)) * gain(p, q)).otherwise(nothing)
    return pairs.join(met, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", (F.coalesce("part", nothing) + absent).alias("value")
    )


def audit(
    documents: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    ranks: int = RANKS,
    cell_rows: int = CELL_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``documents(text, lang, source)``.

    Terms are runs of ASCII letters, A-Z lower-cased, and of all characters beyond ASCII. A language keeps the
    terms in at least ``least_documents`` of its rows. Part ``pair`` has each other source of the language and how far
    the two distributions lie apart, part ``term`` the ``ranks`` kept terms that a source says more than its language.

    Null texts, languages and sources count as empty; an empty text still makes its group. Repeated rows are documents
    of their own. Without kept terms pairs have the value 0 and there are no terms; an empty table gives no rows. Ties are
    ranked by item. Other columns are ignored.
    """
    scratch = Scratch(documents.sparkSession)
    counted = scratch.write("counted", group_counts(documents))
    said = counted.filter("term is not null")
    kept = said.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("all"))
    kept = kept.filter(F.col("docs") >= least_documents).drop("docs")
    counts = said.join(kept, ["lang", "term"]).select("lang", "source", "term", "count", "all")
    counts = scratch.write("counts", counts)
    sums = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("rows"))
    sizes = counts.select("lang", "term", "all").groupBy("lang", "term", "all").agg(F.lit(1).alias("one"))
    sizes = sizes.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("all").alias("lang_total"))
    nothing = F.lit(0).cast("long")
    groups = counted.filter("term is null").select("lang", "source")
    groups = groups.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left")
    filled = [F.coalesce(c, nothing).alias(c) for c in ("total", "rows", "kept", "lang_total")]
    groups = scratch.write("groups", groups.select("lang", "source", *filled))
    scratch.drop("counted")

    over = lookup_join(counts, groups.drop("rows"), ["lang", "source"])
    p = share(F.col("count"), F.col("total"), F.col("kept"))
    q = share(F.col("all"), F.col("lang_total"), F.col("kept"))
    over = over.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    over = over.select("lang", "source", "item", gain(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)
    pairs = pair_values(counts, groups, scratch, cell_rows, block).withColumn("rank", F.row_number().over(order))
    parts = [t.withColumn("part", F.lit(name)) for name, t in (("pair", pairs), ("term", terms))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")
