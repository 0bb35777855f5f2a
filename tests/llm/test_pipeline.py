"""The pipeline against its operators' brute-force versions, and the registered queries against SQL."""

import base64
import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry_points
import corpus_pipeline
from sparkmine.llm import quality, toxicity
from sparkmine.llm.oracle import ORACLE
from tests.llm import test_decontaminate, test_ngram_join
from tests.llm.frames import ODD_TEXTS, documents

TABLES = "documents embeddings pages benchmark conversations".split()


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(str(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = entry_points.queries()[name](spark, sf_dir)
    expected = con.execute(ORACLE[name])
    names = [c[0] for c in expected.description]
    assert rows_of(found.columns, found.collect()) == rows_of(names, expected.fetchall())


def test_thirteen_queries_are_registered():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_points.queries()


def test_run_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.scored(docs, labels).collect() if r.predicted}
    left = {i: t for i, t in texts.items() if i not in toxic}
    calm = docs.filter(~docs.doc_id.isin(list(toxic))) if toxic else docs
    poor = {r.doc_id for r in quality.scored(calm, labels).collect() if r.score <= 1 - quality.THRESHOLD}
    left = {i: t for i, t in left.items() if i not in poor}
    left = {i: left[i] for i, _, component, _ in test_ngram_join.brute(list(left.items())) if i == component}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in test_decontaminate.brute(list(left.items()), items) if r[-1]}
    left = {i: t for i, t in left.items() if i not in bad}
    assert toxic and poor and bad and len(left) < len(texts)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc_id, text in left.items():
        ids = library.encode_ordinary(text)
        coded = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((doc_id, len(ids), coded, hashlib.sha256(text.encode()).hexdigest()))
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, result.collect())) == sorted(expected)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_on_odd_rows(spark, sf_dir, stage):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a text without an id"), (None, None), (50, "twice"), (50, "twice")]
    docs = documents(spark, rows)
    result = stage[1](spark, docs, sf_dir)
    assert result.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in result.collect()]
    assert set(kept) <= set(rows)
    if stage[0] == "ngram_jaccard_join":
        assert kept.count((50, "twice")) == 1 and (None, "a text without an id") in kept and (1, "") in kept
    empty = stage[1](spark, documents(spark, []), sf_dir)
    assert empty.columns == docs.columns and empty.collect() == []


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_columns_with_clashing_names_stay_as_they_are(spark, sf_dir, stage):
    names = "toxicity_score_ toxicity_0_ quality_stat_words quality_0_words QUALITY_0_x row_key_ row_0_ Row_1_ score_ text_".split()
    docs = documents(spark, [(i, f"{w} words of a plain text") for i, w in enumerate("abc")])
    docs = docs.select("*", *[docs.doc_id.cast("string").alias(c) for c in names])
    result = stage[1](spark, docs, sf_dir)
    assert result.schema == docs.schema
    assert all(r[c] == str(r.doc_id) for r in result.collect() for c in names) and result.count()


def test_rows_that_share_an_id_are_judged_one_by_one(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    first, second = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(5, first), (5, second), (3, second), (7, first + " tail"), (8, second + " end"), (8, second + " tail")]
    wordless = [(None, None), (None, None), (None, ""), (9, " "), (9, " "), (9, None)]
    docs = documents(spark, rows + wordless)
    kept = [(r.doc_id, r.text) for r in stages["ngram_jaccard_join"](spark, docs, sf_dir).collect()]
    assert sorted(kept, key=str) == sorted([(5, first), (3, second), *wordless], key=str)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr("max_by(text, length(text))").first()[0]
    docs = documents(spark, [(5, item), (5, first), (None, None)])
    kept = [(r.doc_id, r.text) for r in stages["benchmark_decontamination"](spark, docs, sf_dir).collect()]
    assert sorted(kept, key=str) == sorted([(5, first), (None, None)], key=str)


def test_near_copies_under_one_id_leave_one_row(spark, sf_dir):
    text = " ".join(f"a{i}" for i in range(60))
    docs = documents(spark, [(4, text), (4, text + " tail"), (-2, "alone here"), (None, "also alone")])
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()]
    assert len(kept) == 3 and {i for i, _ in kept} == {4, -2, None}
