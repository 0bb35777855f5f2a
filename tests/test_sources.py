import pytest

from sparkmine.operators.edges import canonical_edges, edge_positions
from sparkmine.sources.text import LINE_ORDER, basket_lines, edge_lines, labelled_text, preview


@pytest.fixture
def write(tmp_path):
    def written(text, name="file.txt"):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path)

    return written


def test_labelled_text(spark, write):
    path = write(
        "ham\tfirst text  \n"
        "no tab here\n"
        "spam\t  \n"
        "\n"
        'ham\tsays "quoted, text" \'here\'\n'
        "  spam\tone\ttwo\t\n"
        "ham\tcafé ½ \n"
    )
    rows = sorted(tuple(r) for r in labelled_text(spark, path).collect())
    assert rows == [
        (1, "sms_1", "ham", "first text"),
        (2, "sms_2", "ham", "says \"quoted, text\" 'here'"),
        (3, "sms_3", "spam", "one\ttwo"),
        (4, "sms_4", "ham", "café ½"),
    ]
    first = labelled_text(spark, path, limit=2, prefix="doc")
    assert sorted(r.doc_id for r in first.collect()) == ["doc1", "doc2"]


def test_file_order_over_files_and_splits(spark, write):
    path = write("".join(f"x\ta{i}\n" for i in range(300)), "a.txt")
    write("".join(f"x\tb{i}\n" for i in range(300)), "b.txt")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "400")
    try:
        rows = sorted((r.n, r.text) for r in labelled_text(spark, path).collect())
    finally:
        spark.conf.set(key, before)
    assert [t for _, t in rows] == [f"a{i}" for i in range(300)] + [f"b{i}" for i in range(300)]
    assert [n for n, _ in rows] == list(range(1, 601))


def test_numbering_moves_no_line(spark, write):
    path = write("".join(f"x\ta{i}\n" for i in range(50)))
    for numbered in (labelled_text(spark, path), labelled_text(spark, path, limit=7), basket_lines(spark, path)):
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "hashpartitioning" not in plan


def test_other_splits_are_noticed(spark, write):
    path = write("".join(f"x\ta{i}\n" for i in range(100)))
    numbered = labelled_text(spark, path)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200")
    try:
        with pytest.raises(Exception, match="split otherwise"):
            numbered.collect()
    finally:
        spark.conf.set(key, before)


def test_basket_lines(spark, write):
    path = write("c a  b\n\n   \n10 9\t9\n")
    assert sorted(tuple(r) for r in basket_lines(spark, path).collect()) == [
        (1, ["a", "b", "c"]),
        (2, ["10", "9"]),
    ]


EDGES = "# comment\n  # indented\n1 2\n2\t1\n1 2 99 extra\n7\n\n3 3\n4 1\n"


def test_edge_lines(spark, write):
    rows = edge_lines(spark, write(EDGES))
    got = sorted(rows.collect(), key=lambda r: r.line_no)
    assert [(r.u, r.v) for r in got] == [(1, 2), (2, 1), (1, 2), (3, 3), (4, 1)]
    stream = edge_positions(canonical_edges(rows, "u", "v", LINE_ORDER))
    assert [tuple(r) for r in preview(stream).collect()] == [(1, 1, 2), (2, 1, 4)]


def test_edge_lines_that_are_no_numbers(spark, write):
    path = write("1 2\na b\n3 x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        edge_lines(spark, path).collect()
    assert [(r.u, r.v) for r in edge_lines(spark, path, skip_bad=True).collect()] == [(1, 2)]
