"""From raw documents to tokens: five stages, each on all that its predecessor kept.

Every stage but the last returns the columns of its input. Stages judge rows by id and text, so rows that share
an id are rows of their own unless their texts are equal, too.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import bpe, decontaminate, ngram_join, quality, toxicity
from sparkmine.llm.tables import Scratch


def free(docs: DataFrame, name: str) -> str:
    """A beginning of names that no column of ``docs`` has, whatever its case."""
    taken, number = [c.lower() for c in docs.columns], 0
    while any(c.startswith(f"{name}_{number}_") for c in taken):
        number += 1
    return f"{name}_{number}_"


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def row_id() -> Column:
    """doc_id, or for a row without one a negative number that its text decides."""
    return F.coalesce(F.col("doc_id").cast("long"), -F.abs(F.xxhash64("text") % (1 << 62)) - 2)


def row_key() -> Column:
    """Binary, equal for rows of equal id and text: :func:`row_id` so that it sorts as a number, and a digest of the text."""
    number = F.lpad(F.hex(row_id().bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.unhex(F.concat(number, F.coalesce(F.md5("text"), F.lit("0" * 32))))


def has_words() -> Column:
    """Whether the text has a character that does not separate words for operator 1."""
    return F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that operator 8 does not predict to be toxic."""
    machine = toxicity.train(docs, labels_of(spark, sf_dir))
    name = free(docs, "toxicity")
    return toxicity.with_score(docs, machine, name).filter(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that operator 10 does not reject.

    A row is rejected if label 0 is as likely as a prediction of 1 asks of label 1, so a row of which the
    rules cannot tell, such as one of two words, stays.
    """
    ensemble = quality.train(docs, labels_of(spark, sf_dir))
    prefix = free(docs, "quality")
    good = ensemble.column(prefix) > 1 - quality.THRESHOLD
    return quality.with_statistics(docs, prefix).filter(good).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the least id, of each group that operator 1 finds; all rows without words stay.

    The law is operator 1's: sets of 3 words, 90 percent. Of rows with the least id, that with the least digest of the
    text stays.
    """
    scratch, row = Scratch(spark), free(docs, "row")
    worded = docs.filter(has_words()).withColumn(row, row_key())
    keyed = worded.select(F.col(row).alias("doc_id"), "text")
    found = ngram_join.near_duplicates(keyed, k=ngram_join.WORDS, percent=ngram_join.PERCENT)
    first = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(row)).distinct()
    first = scratch.write("first", first)
    kept = worded.join(first, row, "left_semi").dropDuplicates([row])
    return kept.select(*docs.columns).unionByName(docs.filter(~has_words()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that operator 2 does not call contaminated."""
    scratch, row = Scratch(spark), free(docs, "row")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs.select(row_key().alias("doc_id"), "text"), benchmark)
    bad = scratch.write("bad", found.filter("contaminated").select(F.col("doc_id").alias(row)).distinct())
    return docs.withColumn(row, row_key()).join(bad, row, "left_anti").select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoded_digests(docs.select("doc_id", "text"), ranks)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]

# Trained models and a tokenizer decide the rows; tests compare them with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, each stage written and read again before the next."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = scratch.write(name, stage(spark, docs, sf_dir))
        if before:
            scratch.drop(before)
        before = name
    return docs
