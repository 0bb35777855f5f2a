"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import (
    bpe,
    chat,
    conversation_repair,
    decontaminate,
    divergence,
    ngram_join,
    quality,
    sharding,
    token_count,
    token_files,
    topk,
    toxicity,
    url_filter,
)
from sparkmine.llm.tables import Scratch

# The rules of op 7.
URL_RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)
# Fixed value: the extra conversation of op 5.
EXTRA_TEXT = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: component and links of each document."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: how much of each document occurs in the benchmark."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: token ids of each document and the bytes decoded from them, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoded_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks)


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: the 20 best rows of each vector whose id is divisible by 20."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: digests read back from the formatted conversations."""
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TEXT).alias("text"),
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(given.unionByName(extra), public_tokenizers.path("byte_bpe_50k.json"))
    return chat.digests(formatted).drop("n_tokens", "n_loss_tokens")


def balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: all documents in shards 0 to 15 of nearly equal bytes."""
    return sharding.shard(table(spark, sf_dir, "documents"), 16)


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: rule and verdict of each page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: toxicity of each document."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: tokens of each document under the unigram model, and the score of that segmentation."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(documents, public_tokenizers.path("piece_bpe_32k.model"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: quality of each document."""
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: how each source differs from its language and from the language's other sources."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: faults of each damaged conversation, its cheapest repair and a digest of the result."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.digests(conversation_repair.repair(rows))


def binary_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: where the ids of each document lie in the written files, and a check sum of those read back."""
    path = Scratch(spark).path("token_files")
    token_files.write_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_files.digests(spark, path)


QUERIES = {
    "op1_ngram_jaccard_join": ngram_jaccard_join,
    "op2_benchmark_decontamination": benchmark_decontamination,
    "op3_byte_bpe": byte_bpe,
    "op4_exact_top_k": exact_top_k,
    "op5_chat_formatting": chat_formatting,
    "op6_balanced_shards": balanced_shards,
    "op7_url_rules": url_rules,
    "op8_toxicity": toxicity_scores,
    "op9_token_counts": token_counts,
    "op10_quality": quality_scores,
    "op11_source_divergence": source_divergence,
    "op12_conversation_repair": repaired_conversations,
    "op13_binary_token_ids": binary_token_ids,
}
