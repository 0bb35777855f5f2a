"""Operator 1 against brute force."""

import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from sparkmine.llm import ngram_join, texts
from sparkmine.llm.components import components
from sparkmine.llm.tables import Scratch
from tests.llm.frames import ODD_TEXTS, changed, documents, sentence


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 3:
        return {tuple(words)}
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def brute(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    links = [
        {j for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= percent * len(a | b)}
        for i, a in enumerate(sets)
    ]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, front = {i}, [i]
        while front:
            new = links[front.pop()] - seen
            seen |= new
            front += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None), len(links[i])))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = list(ODD_TEXTS) + ["one", "two words", "", "a b c", "A  b\nc"]
    for _ in range(12):
        base = sentence(rng, rng.choice([9, 11, 12, 13, 30, 90, 200]), [f"v{i}" for i in range(60)])
        texts += [base] * rng.choice([1, 1, 3])
        texts += [changed(rng, base, rng.choice([1, 1, 2, 4])) for _ in range(rng.choice([2, 4, 25]))]
        texts += [base + " tail", "head " + base]
    order = list(range(100, 100 + len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts, strict=True))


@pytest.mark.parametrize("block", [3, 512])
def test_equals_brute_force(spark, rows, block):
    assert found(ngram_join.near_duplicates(documents(spark, rows), block=block)) == brute(rows)


def test_other_thresholds(spark, rows):
    assert found(ngram_join.near_duplicates(documents(spark, rows), percent=70)) == brute(rows, 70)


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h i j k l m n o p"
    rows = [(1, text), (1, text), (None, text), (2, text + " q"), (None, "alone in this"), (None, None), (3, "")]
    assert found(ngram_join.near_duplicates(documents(spark, rows))) == brute(rows)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = sentence(rng, 120, [f"v{i}" for i in range(500)])
    rows = [(i, changed(rng, base, rng.choice([1, 2, 3]))) for i in range(150)]
    assert found(ngram_join.near_duplicates(documents(spark, rows), block=20)) == brute(rows)


@pytest.mark.parametrize("count", [200, 400])
def test_sets_too_far_apart_to_link_make_no_rows(spark, count, monkeypatch):
    """All share words of one base, few are linked across pivots: rows follow the links, not the square of the group."""
    rng = random.Random(count)
    base = sentence(rng, 120, [f"v{i}" for i in range(5000)])
    rows = [(i, changed(rng, base, rng.choice([2, 3, 3, 4]))) for i in range(count)]
    joined, made = ngram_join.meetings, []

    def counted(*given):
        made.append(joined(*given).count())
        return joined(*given)

    monkeypatch.setattr(ngram_join, "meetings", counted)
    assert found(ngram_join.near_duplicates(documents(spark, rows), block=64)) == brute(rows)
    assert made[0] <= count


def test_long_lists_are_met_in_blocks(spark, rows, monkeypatch):
    joined = ngram_join.meetings
    monkeypatch.setattr(ngram_join, "meetings", lambda *given: joined(*given, list_rows=2))
    each = lambda met, scratch, percent: met.select("digest").distinct().selectExpr("digest", "digest pivot")
    monkeypatch.setattr(ngram_join, "pivots_of", each)
    assert found(ngram_join.near_duplicates(documents(spark, rows))) == brute(rows)


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(2)
    for n in (1, 40, 3000):
        a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        b = np.unique(np.append(rng.permutation(a)[: n - n // 9], rng.integers(0, 1 << 64, n // 7, dtype=np.uint64)))
        odd = np.bitwise_count((ngram_join.parity(a) ^ ngram_join.parity(b)).view(np.uint64)).sum()
        apart = len(np.setxor1d(a, b))
        assert odd <= apart and odd % 2 == apart % 2


def digest(text):
    batch = pa.RecordBatch.from_pydict({"text": pa.array([text])})
    [(_, sets)] = ngram_join._shingles(batch, 3, texts.byte_weights(texts.SPACES))
    return ngram_join.set_digest(sets[0])


def led_chain(depth, last):
    """Texts of which each is led by the one before, ``depth`` deep, and ``last`` that are led by the deepest."""

    def until(fits, name, count):
        """Words of which ``fits`` is true."""
        tries = (" ".join(f"{name}x{t}y{i}" for i in range(count)) for t in range(10_000))
        return next(words for words in tries if fits(words))

    start = " ".join(f"c{i}" for i in range(412))
    own, out = " ".join(f"r{i}" for i in range(20)), []
    for i in range(depth):
        begun = f"{start} {own} "
        own = until(lambda w, b=begun, i=i: digest(b + w)[0] // 16 == i, f"r{i}", 20)
        out.append(begun + own)
    begun = f"{start} {own} "
    return out + [begun + until(lambda w: digest(begun + w)[0] // 16 > depth, f"s{j}", 6) for j in range(last)]


@pytest.mark.parametrize("depth", [5, 12])
def test_sets_far_from_the_least_of_their_chain(spark, depth, monkeypatch):
    monkeypatch.setattr(ngram_join, "SALT", 2)
    rows = list(enumerate(led_chain(depth, 14)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # salts stay in tasks of their own
    try:
        got = found(ngram_join.near_duplicates(documents(spark, rows), block=2))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(rows)


def test_every_pivot_is_its_own_pivot(spark):
    names = [bytes([i]) for i in range(20)]
    lists = [(k, names[i], 40) for k, i in [(10 * i + j, i + s) for i in range(19) for j in range(2) for s in (0, 1)]]
    met = spark.createDataFrame(lists, "key long, digest binary, n int")
    got = {bytes(r.digest): bytes(r.pivot) for r in ngram_join.pivots_of(met, Scratch(spark), 90).collect()}
    assert got == dict.fromkeys(names, names[0])


def test_empty_table(spark):
    assert found(ngram_join.near_duplicates(documents(spark, []))) == []


def test_pairs_with_different_pivots_are_kept(spark, rows, monkeypatch):
    """With every set its own pivot, all links come from pairs."""
    monkeypatch.setattr(
        ngram_join, "pivots_of", lambda met, scratch, percent: met.select("digest").distinct().selectExpr("digest", "digest pivot")
    )
    assert found(ngram_join.near_duplicates(documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("percent", [70, 80, 90, 95])
def test_linked_sets_agree_on_a_block(percent):
    """Of each two sizes that can be linked, both are cut into some equal number of blocks above their difference."""
    for n in range(ngram_join.least_size(percent), 700):
        for other in range(n, n * 100 // percent + 1):
            shared = -(-percent * (n + other) // (100 + percent))
            apart = n + other - 2 * shared
            both = set(ngram_join.block_counts(n, percent)) & set(ngram_join.block_counts(other, percent))
            assert any(m > apart for m in both)


def test_block_names_agree_where_blocks_do():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 64, 300, dtype=np.uint64))
    b = np.delete(a, rng.integers(0, len(a), 10))
    c = np.unique(rng.integers(0, 1 << 64, 300, dtype=np.uint64))
    names = [set(ngram_join.block_names(x, 90).tolist()) for x in (a, b, c)]
    assert len(names[0] & names[1]) > 10 and len(names[0] & names[2]) <= 1  # an empty block, at most


def test_common_counts_in_parts(monkeypatch):
    monkeypatch.setattr(ngram_join, "TOGETHER", 3)
    rng = np.random.default_rng(1)
    sets = [set(rng.integers(0, 30, rng.integers(0, 12)).tolist()) for _ in range(20)]
    flat = np.array([v for s in sets for v in sorted(s)])
    owner = np.array([i for i, s in enumerate(sets) for _ in s])
    got = ngram_join.common_counts(flat, owner, len(sets))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(a & b)


def test_components_of_paths_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 201), (201, 200)]
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in components(frame, Scratch(spark)).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100, 201: 200}
    assert components(frame.limit(0), Scratch(spark)).collect() == []


def test_small_tables_have_few_files(spark, rows, monkeypatch):
    """However many partitions a shuffle has, tables made by light steps have a file for each core at most."""
    files: dict[str, int] = {}
    write = Scratch.write

    def noted(self, name, *rest):
        made = write(self, name, *rest)
        files[name.split("_")[0]] = len(list(Path(self.live[name].removeprefix("file:")).glob("part-*")))
        return made

    monkeypatch.setattr(Scratch, "write", noted)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert found(ngram_join.near_duplicates(documents(spark, rows))) == brute(rows)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    light = "classes common agreeing repeated met leaders pivots mixed lists long needed sizes links named".split()
    cores = spark.sparkContext.defaultParallelism
    assert {n: files[n] for n in light if files[n] > cores} == {}
