"""The registered queries against their SQL, at the smallest scale.

Queries whose SQL takes long or whose parts are tested elsewhere are left to the driver's check.
"""

import time
from pathlib import Path
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from sparkmine.catalog.oracle import ORACLE
from sparkmine.catalog.queries import QUERIES
from sparkmine.operators import storage

TABLES = "events documents lineitem part".split()
CHECKED = [
    "lsh_quality_crowded",
    "near_duplicates_crowded",
    "lsh_band_plan",
    "basket_items_support",
    "itemsets_level2",
    "node_neighbors",
    "triest_stream_simple",
    "text_normalize",
    "text_groups",
    "shingle_counts",
    "jaccard_pairs",
    "labelled_texts",
    "basket_file",
    "edge_file",
    "candidates_pruned",
    "association_rules",
    "edges_shuffled",
    "reservoir_log",
    "common_neighbors",
    "triest_error",
]


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    shown = [
        tuple("" if r[i] is None else f"{r[i]:.6f}" if isinstance(r[i], float) else str(r[i]) for i in order)
        for r in data
    ]
    return sorted(columns), sorted(shown)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{entry_points.SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sf_dir, con, name):
    found = entry_points.queries()[name](spark, sf_dir)
    expected = con.execute(entry_points.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert rows(found.columns, found.collect()) == rows(names, expected.fetchall())


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()


def session(master):
    """What the folder is read from: a session that names none."""
    given = {}
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: given.get("folder"), setCheckpointDir=lambda f: given.update(folder=f)
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)


def test_a_cluster_must_name_its_folder():
    look = entry_points.with_folder(lambda spark, sf_dir: storage.work_dir(spark))
    with pytest.raises(ValueError):
        look(session("spark://host:7077"), "")
    assert "sparkmine-" in look(session("local[4]"), "")


def test_a_workspace_leaves_nothing(spark):
    with storage.Workspace(spark) as work:
        entry_points.queries()["lsh_quality"](spark, entry_points.SMALL).collect()
        assert storage.names_below(spark, work.folder)
    assert not storage.names_below(spark, work.folder)


def test_small_is_judged_by_bytes(spark):
    values = [(i, "x" * 100, ["y" * 50] * 3) for i in range(100)]
    rows = storage.durable(spark.createDataFrame(values, "i int, s string, a array<string>"))
    assert storage.small(rows, 100 * 500) and not storage.small(rows, 100 * 250) and not storage.small(rows, 10)
    storage.release(rows)
    with pytest.raises(Exception, match="not exist|NOT_EXIST"):
        rows.count()


def test_a_durable_table_leaves_no_shuffle(spark):
    """Its shuffle files are removed, the session's setting stays, and a frame that was collected before can be again."""

    def shuffles():
        places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {file.name for place in places for file in Path(place).rglob("shuffle_*")}

    rows = spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(rows.collect()) == 7
    for given in (None, "false", "true"):
        if given:
            spark.conf.set(storage.CLEANUP, given)
        before = shuffles()
        table = storage.durable(rows)
        deadline = time.time() + 20
        while shuffles() - before and time.time() < deadline:
            time.sleep(0.1)
        assert not shuffles() - before
        assert spark.conf.get(storage.CLEANUP, None) == given
        assert table.count() == len(rows.collect()) == 7
    spark.conf.unset(storage.CLEANUP)


def test_flagship(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["id1", "id2", "copies1", "copies2", "jaccard"]
    assert frame.count() > 0
