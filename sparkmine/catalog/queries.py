"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.functions.minhash import band_plan
from sparkmine.operators import edges as edge_ops
from sparkmine.operators import itemsets as itemset_ops
from sparkmine.operators import lsh
from sparkmine.operators import rules as rule_ops
from sparkmine.operators.order import number_rows, shuffled_order
from sparkmine.operators.reservoir import Run, sample_at
from sparkmine.operators.storage import durable, new_path, stored_bytes
from sparkmine.plans.baskets import MarketBaskets
from sparkmine.plans.neardup import NearDuplicates
from sparkmine.plans.triest import TriangleStream, size_by_ratio
from sparkmine.sources.text import basket_lines, edge_line_stream, edge_lines, labelled_text, preview
from sparkmine.streaming.triangles import TriangleState, triangle_stream

SHINGLE = 10
HASHES = 100
THRESHOLD = 0.8
SUPPORT = 0.01
PRUNING_SUPPORT = 0.02  # for queries in which the bound and the subset test remove something
TINY_BLOCK = 2  # rows of a bucket paired at once, where every bucket shall be cut
CONFIDENCE = 0.1
BASKET_PART = 5
FIRST_DOCS = 500
SAMPLE = Run(1000, 7)
SAMPLE_TIME = 3000
SWEEP = [Run(size) for size in (1000, 2500, 5000, 7000, 10000, 13000, 16000, 20000)]
RATIO = 0.10
EVERY = 1000
SHUFFLE_SEED = 11

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def big(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def rounded(name: str) -> Column:
    return F.round(name, 6).alias(name)


def joined(name: str, sep: str = "|") -> Column:
    return F.array_join(name, sep).alias(name)


# Near-duplicate text


def dealt(df: DataFrame, key: str, split_bytes: int = 32 << 20) -> DataFrame:
    """Deal a table of fewer files than there are cores over the cores; its shape is read from the files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if stored_bytes(df) < cores * split_bytes else df


def documents(spark: SparkSession, sf_dir: str, **options) -> NearDuplicates:
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return NearDuplicates(docs, k=SHINGLE, n=HASHES, threshold=THRESHOLD, **options)


@query
def text_normalize(spark, sf_dir):
    return documents(spark, sf_dir).normalized.select("doc_id", "normalized")


@query
def shingle_counts(spark, sf_dir):
    return documents(spark, sf_dir).statistics.select("doc_id", big("n_chars"), "n_shingles")


@query
def shingle_hashes(spark, sf_dir):
    found = documents(spark, sf_dir).statistics.filter("n_shingles > 0")
    return found.select("doc_id", "min_hash", "max_hash", "sum_hash")


@query
def shingle_frequency(spark, sf_dir):
    return documents(spark, sf_dir).frequencies.groupBy("docs").agg(F.count(F.lit(1)).alias("shingles"))


@query
def text_groups(spark, sf_dir):
    return documents(spark, sf_dir).members


@query
def jaccard_pairs(spark, sf_dir):
    return documents(spark, sf_dir).true_pairs.select(
        "id1", "id2", "copies1", "copies2", big("size1"), big("size2"), big("shared"), rounded("jaccard")
    )


@query
def minhash_signatures(spark, sf_dir):
    return documents(spark, sf_dir).signatures.select("doc_id", joined("signature", ","))


@query
def minhash_estimate(spark, sf_dir):
    return documents(spark, sf_dir).estimated().select("id1", "id2", rounded("estimate"))


@query
def lsh_buckets(spark, sf_dir):
    members = lsh.bucket_members(documents(spark, sf_dir).band_rows)
    return members.select(big("band"), "bucket_id", "group_id", "groups", "docs")


@query
def lsh_candidates(spark, sf_dir):
    return documents(spark, sf_dir).candidates


@query
def lsh_candidates_crc(spark, sf_dir):
    return documents(spark, sf_dir, crc_bands=True).candidates


@query
def lsh_verified(spark, sf_dir):
    return documents(spark, sf_dir).verified.select(
        "id1", "id2", "copies1", "copies2", rounded("jaccard"), "is_similar"
    )


@query
def lsh_band_plan(spark, sf_dir):
    """How the signatures are cut, and how many buckets each band has."""
    rows = documents(spark, sf_dir).band_rows
    bands, per_band = band_plan(HASHES, THRESHOLD)
    return rows.groupBy(big("band")).agg(
        F.lit(bands).cast("bigint").alias("bands"),
        F.lit(per_band).cast("bigint").alias("rows_per_band"),
        F.count(F.lit(1)).alias("groups"),
        F.count_distinct("key").alias("buckets"),
    )


@query
def lsh_missed(spark, sf_dir):
    return documents(spark, sf_dir).missed.select("id1", "id2", rounded("jaccard"))


def _quality(job):
    return job.quality.select(
        big("true_positives"),
        big("false_positives"),
        big("false_negatives"),
        rounded("recall"),
        rounded("precision"),
    )


def _similar(job):
    return job.similar.select("id1", "id2", "copies1", "copies2", rounded("jaccard"))


@query
def lsh_quality(spark, sf_dir):
    return _quality(documents(spark, sf_dir))


@query
def lsh_quality_crowded(spark, sf_dir):
    """With every bucket of more than two groups cut into blocks."""
    return _quality(documents(spark, sf_dir, block_rows=TINY_BLOCK))


@query
def near_duplicates(spark, sf_dir):
    return _similar(documents(spark, sf_dir))


@query
def near_duplicates_crowded(spark, sf_dir):
    """With every bucket of more than two groups cut into blocks."""
    return _similar(documents(spark, sf_dir, block_rows=TINY_BLOCK))


@query
def near_duplicates_drop_empties(spark, sf_dir):
    return documents(spark, sf_dir, empties="drop").quality.select(
        big("true_positives"), big("false_positives"), big("false_negatives")
    )


# Text files, written from the given tables


def _written(lines: DataFrame, order: list[str], name: str) -> str:
    path = new_path(lines.sparkSession, name)
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.text(path)
    return path


def _labelled_path(spark, sf_dir):
    one_line = F.regexp_replace("text", r"[\r\n]+", " ")
    line = F.concat("lang", F.lit("\t"), one_line).alias("line")
    docs = table(spark, sf_dir, "documents").dropna(subset=["lang", "text"])
    return _written(docs.select("doc_id", line), ["doc_id"], "labelled")


@query
def labelled_texts(spark, sf_dir):
    return labelled_text(spark, _labelled_path(spark, sf_dir))


@query
def labelled_texts_first(spark, sf_dir):
    first = labelled_text(spark, _labelled_path(spark, sf_dir), limit=FIRST_DOCS)
    return first.select("n", "doc_id", "label")


@query
def basket_file(spark, sf_dir):
    lines = basket_table(spark, sf_dir, "p_brand", with_blanks=True)
    path = _written(lines, ["tid"], "baskets")
    return basket_lines(spark, path).select("tid", joined("items"))


def basket_table(spark, sf_dir, item, with_blanks=False):
    items = order_items(spark, sf_dir, item)
    if with_blanks:
        items = items.withColumn("item", F.regexp_replace("item", " ", "_"))
    gathered = itemset_ops.gathered(items)  # a line of the file is a part: here each basket is one
    return gathered.select("tid", F.array_join("items", "  ").alias("line")) if with_blanks else gathered


@query
def edge_file(spark, sf_dir):
    line = F.concat_ws("\t", "u", "v", "n").alias("line")
    path = _written(user_steps(spark, sf_dir).select("n", line), ["n"], "edges")
    read = edge_lines(spark, path)
    return read.groupBy("u", "v").agg(F.count(F.lit(1)).alias("arrivals"))


# Frequent itemsets and rules


def order_items(spark, sf_dir, item):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.expr(item).alias("item"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    sold = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return itemset_ops.basket_items(sold, "l_orderkey", "item")


def baskets(spark, sf_dir, item, max_k=None, support=SUPPORT):
    cores = spark.sparkContext.defaultParallelism
    return MarketBaskets(order_items(spark, sf_dir, item), support, CONFIDENCE, max_k, cores)


@query
def basket_items(spark, sf_dir):
    """Baskets in parts of at most five items."""
    parts = itemset_ops.gathered(order_items(spark, sf_dir, "p_type"), BASKET_PART)
    return parts.select("tid", big("part"), joined("items"))


@query
def basket_items_support(spark, sf_dir):
    """Items of brand and type, of which the bound removes some."""
    level = baskets(spark, sf_dir, "p_brand || ' ' || p_type", 1, PRUNING_SUPPORT).level(1)
    return level.select(joined("itemset"), "cnt")


@query
def itemsets_level2(spark, sf_dir):
    """Pairs of brands, of which the bound removes some."""
    level = baskets(spark, sf_dir, "p_brand", 2, PRUNING_SUPPORT).level(2)
    return level.select(joined("itemset"), "cnt")


@query
def candidates_pruned(spark, sf_dir):
    """Triples of brands, of which the subset test removes some."""
    return baskets(spark, sf_dir, "p_brand", 2, PRUNING_SUPPORT).candidates(3).select(joined("itemset"))


@query
def itemsets_level3(spark, sf_dir):
    level = baskets(spark, sf_dir, "p_type", max_k=3).level(3)
    return level.select(joined("itemset"), "cnt")


@query
def frequent_itemsets(spark, sf_dir):
    found = baskets(spark, sf_dir, "p_type").itemsets
    return itemset_ops.report(found).select(big("k"), joined("itemset"), "cnt", rounded("support"))


@query
def itemset_totals(spark, sf_dir):
    return itemset_ops.totals(baskets(spark, sf_dir, "p_type").itemsets).select(big("k"), "itemsets")


@query
def association_rules(spark, sf_dir):
    return rule_ops.report(baskets(spark, sf_dir, "p_type").rules).select(
        joined("antecedent"),
        joined("consequent"),
        "support_cnt",
        rounded("support"),
        rounded("confidence"),
        rounded("lift"),
    )


# Edge streams and triangles


def user_steps(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return edge_ops.successive(events, "user_id", ["ts", "event_id"])


def clean_edges(spark, sf_dir):
    return edge_ops.canonical_edges(user_steps(spark, sf_dir), "u", "v", ["n"])


def edge_stream(spark, sf_dir):
    return durable(edge_ops.edge_positions(clean_edges(spark, sf_dir)), "edges")


def sampled(spark, sf_dir, runs=(SAMPLE,)):
    return TriangleStream(dealt(edge_stream(spark, sf_dir), "t"), list(runs))


@query
def row_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n"))
    orders = order_items(spark, sf_dir, "p_type").agg(F.count_distinct("tid").alias("n"))
    edges = clean_edges(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    named = [("documents", docs), ("baskets", orders), ("edges", edges)]
    first, *rest = [counted.select(F.lit(name).alias("what"), "n") for name, counted in named]
    for counted in rest:
        first = first.union(counted)
    return first


@query
def edges_clean(spark, sf_dir):
    return clean_edges(spark, sf_dir).select("a", "b", F.col("first.n").alias("n"))


@query
def edge_positions(spark, sf_dir):
    return edge_stream(spark, sf_dir)


@query
def edge_preview(spark, sf_dir):
    return preview(edge_stream(spark, sf_dir))


@query
def edges_shuffled(spark, sf_dir):
    mixed = shuffled_order(edge_stream(spark, sf_dir).withColumnRenamed("t", "was"), "was", SHUFFLE_SEED)
    return number_rows(mixed, ["shuffle_key", "was"], "t").select("t", "was", "a", "b")


@query
def reservoir_log(spark, sf_dir):
    return sampled(spark, sf_dir).log.drop("run")


@query
def reservoir_final(spark, sf_dir):
    return sampled(spark, sf_dir).final_sample.select("slot", "t_in", "a", "b")


@query
def reservoir_at(spark, sf_dir):
    return sample_at(sampled(spark, sf_dir).lives, SAMPLE_TIME).select("slot", "t_in", "a", "b")


@query
def node_degree(spark, sf_dir):
    return edge_ops.node_degrees(edge_stream(spark, sf_dir))


@query
def node_neighbors(spark, sf_dir):
    edges = durable(sampled(spark, sf_dir).final_sample, "sample")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return edge_ops.neighbors_of(edges, nodes)


@query
def common_neighbors(spark, sf_dir):
    stream = sampled(spark, sf_dir)
    sample = durable(stream.final_sample, "sample")
    return edge_ops.common_neighbors(sample, stream.edges)


@query
def triangles_exact(spark, sf_dir):
    return edge_ops.exact_triangles(edge_stream(spark, sf_dir)).select(big("triangles"))


def _estimates(estimates):
    return estimates.select(big("size"), F.round("estimate", 3).alias("estimate"))


@query
def triest_estimate(spark, sf_dir):
    return _estimates(sampled(spark, sf_dir).estimates)


@query
def triest_by_ratio(spark, sf_dir):
    edges = edge_stream(spark, sf_dir)
    run = Run(size_by_ratio(edges.count(), RATIO))
    return _estimates(TriangleStream(edges, [run]).estimates)


@query
def triest_history(spark, sf_dir):
    return sampled(spark, sf_dir).history(EVERY)


@query
def triest_sweep(spark, sf_dir):
    return _estimates(sampled(spark, sf_dir, SWEEP).estimates)


@query
def triest_error(spark, sf_dir):
    return sampled(spark, sf_dir, SWEEP).errors().select(
        big("size"),
        big("triangles"),
        F.round("abs_error", 3).alias("abs_error"),
        rounded("rel_error"),
        "band",
    )


def _streamed(spark, arrived, dedupe):
    """The rows ``u, v, pos`` come as files in three parts; the stream is stopped and resumed between them."""
    last = arrived.agg(F.max("pos")).first()[0]
    path, folder = new_path(spark, "arrivals"), new_path(spark, "state")
    state = TriangleState(spark, folder, SAMPLE)
    for part in range(3):
        share = (F.col("pos") > last * part // 3) & (F.col("pos") <= last * (part + 1) // 3)
        arrived.filter(share).write.mode("append").parquet(path)
        arrivals = spark.readStream.schema(arrived.schema).parquet(path)
        writer = triangle_stream(arrivals, state, f"{folder}/checkpoint", dedupe)
        writer.trigger(availableNow=True).start().awaitTermination()
    return state.latest().select("edges", F.round("estimate", 3).alias("estimate"))


@query
def triest_stream(spark, sf_dir):
    """All steps as lines of text files, in which edges repeat and nothing but their order tells their positions."""
    steps = durable(user_steps(spark, sf_dir), "steps")
    last = steps.agg(F.max("n")).first()[0]
    path, folder = new_path(spark, "lines"), new_path(spark, "state")
    state = TriangleState(spark, folder, SAMPLE)
    line = F.concat_ws("\t", "u", "v").alias("line")
    for part in range(3):
        share = (F.col("n") > last * part // 3) & (F.col("n") <= last * (part + 1) // 3)
        arrived = steps.filter(share).select("n", line).repartitionByRange("n").sortWithinPartitions("n")
        arrived.select("line").write.text(f"{path}/part={part}")
        writer = triangle_stream(edge_line_stream(spark, f"{path}/*"), state, f"{folder}/checkpoint", dedupe=True)
        writer.trigger(availableNow=True).start().awaitTermination()
    return state.latest().select("edges", F.round("estimate", 3).alias("estimate"))


@query
def triest_stream_simple(spark, sf_dir):
    """Each edge once, at its first step: a stream that needs no memory but the reservoir."""
    firsts = clean_edges(spark, sf_dir).select(
        F.col("a").alias("u"), F.col("b").alias("v"), F.col("first.n").alias("pos")
    )
    return _streamed(spark, durable(firsts, "firsts"), dedupe=False)
