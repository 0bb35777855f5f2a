import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkmine.functions import text, windows
from sparkmine.functions.minhash import EMPTY, band_plan
from sparkmine.operators import jaccard_join, lsh, skew, storage
from sparkmine.operators.documents import normalized_documents, set_statistics
from sparkmine.operators.jaccard_join import BUCKET_BITS, prefixes_of, similar_pairs
from sparkmine.operators.skew import heavy_keys, pairs_sharing_key, salted_join
from sparkmine.plans.neardup import NearDuplicates
from tests import brute

K, N, T = 5, 20, 0.6


def corpus():
    rng = random.Random(3)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "sed", "magna", "erat", "vero", "duo"]
    base = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(6)]
    docs = []
    for text in base:
        for _ in range(6):
            tokens = text.split()
            for _ in range(rng.randrange(4)):
                tokens[rng.randrange(len(tokens))] = rng.choice(words)
            docs.append(" ".join(tokens))
    docs += ["A copy, repeated!"] * 30 + ["a COPY repeated", "ab", "", "x y", "ab!"]
    rng.shuffle(docs)
    return {i: t for i, t in enumerate(docs, 100)}


CORPUS = corpus()
SETS = {i: brute.shingle_set(t, K) for i, t in CORPUS.items()}
SIGNATURES = {i: brute.signature(s, N) for i, s in SETS.items()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(CORPUS.items()), "doc_id bigint, text string")


@pytest.fixture(scope="module")
def job(docs):
    return NearDuplicates(docs, k=K, n=N, threshold=T)


def document_pairs(job, pairs):
    """All document pairs that pairs of groups and the groups themselves stand for."""
    members = {}
    for row in job.members.collect():
        members.setdefault(row.group_id, []).append(row.doc_id)
    found = set()
    for ids in members.values():
        found.update(itertools.combinations(sorted(ids), 2))
    for row in pairs.select("id1", "id2").collect():
        for x, y in itertools.product(members[row.id1], members[row.id2]):
            found.add((min(x, y), max(x, y)))
    return found


def test_exact_join(job):
    assert document_pairs(job, job.true_pairs) == brute.similar(SETS, T)


def test_exact_join_values(job):
    for row in job.true_pairs.collect():
        s, t = SETS[row.id1], SETS[row.id2]
        assert (row.size1, row.size2, row.shared) == (len(s), len(t), len(s & t))
        assert row.jaccard == brute.jaccard(s, t)


@pytest.mark.parametrize("threshold", [0.1, 0.9])
def test_exact_join_thresholds(docs, threshold):
    job = NearDuplicates(docs, k=K, n=N, threshold=threshold)
    assert document_pairs(job, job.true_pairs) == brute.similar(SETS, threshold)


def test_candidates(job):
    bands, rows = band_plan(N, T)
    expected = brute.candidates(SIGNATURES, bands, rows, lambda values: values)
    assert document_pairs(job, job.candidates) == expected


def test_candidates_crc(docs):
    job = NearDuplicates(docs, k=K, n=N, threshold=T, crc_bands=True)
    bands, rows = band_plan(N, T)
    expected = brute.candidates(
        SIGNATURES, bands, rows, lambda values: zlib.crc32(str(values).encode())
    )
    assert document_pairs(job, job.candidates) == expected


def test_crc_key_of_single_rows_and_empty_sets(spark):
    from sparkmine.functions.minhash import band_keys

    df = spark.createDataFrame([([1, 2],), ([EMPTY, EMPTY],)], "s array<bigint>")
    inf = float("inf")
    for values, single, double in zip(
        [[1, 2], [inf, inf]],
        df.select(band_keys(F.col("s"), 2, 1, crc=True)).collect(),
        df.select(band_keys(F.col("s"), 1, 2, crc=True)).collect(),
    ):
        assert single[0] == [zlib.crc32(str((v,)).encode()) for v in values]
        assert double[0] == [zlib.crc32(str(tuple(values)).encode())]


@pytest.mark.parametrize("block_rows", [1, 3, None])
def test_quality(docs, block_rows):
    job = NearDuplicates(docs, k=K, n=N, threshold=T, block_rows=block_rows)
    bands, rows = band_plan(N, T)
    cand = brute.candidates(SIGNATURES, bands, rows, lambda values: values)
    true = brute.similar(SETS, T)
    row = job.quality.first()
    assert row.true_positives == len(cand & true)
    assert row.false_positives == len(cand - true)
    assert row.false_negatives == len(true - cand)
    assert row.recall == pytest.approx(len(cand & true) / len(true))
    assert row.precision == pytest.approx(len(cand & true) / len(cand))


@pytest.mark.parametrize("block_rows", [1, None])
def test_totals(job, block_rows):
    one = lsh.band_rows(job.banded.withColumn("copies", F.lit(1)))
    assert lsh.candidate_totals(one, block_rows).agg(F.sum("pairs")).first()[0] == job.candidates.count()


def test_similar_and_missed(job):
    bands, rows = band_plan(N, T)
    cand = brute.candidates(SIGNATURES, bands, rows, lambda values: values)
    true = brute.similar(SETS, T)
    assert document_pairs(job, job.similar) == cand & true
    missed = document_pairs(job, job.missed) - document_pairs(job, job.missed.limit(0))
    assert missed == true - cand


@pytest.mark.parametrize("block_rows", [1, 3])
def test_blocks_of_buckets_give_the_same_pairs(docs, job, block_rows):
    usual = job.similar.collect()
    cut = NearDuplicates(docs, k=K, n=N, threshold=T, block_rows=block_rows)
    assert sorted(cut.similar.select(*job.similar.columns).collect()) == sorted(usual)


def test_candidates_come_once(job):
    pairs = [tuple(r) for r in lsh.candidate_pairs(job.band_rows).collect()]
    assert len(pairs) == len(set(pairs)) == job.candidates.count()


def test_estimate(job):
    for row in job.estimated().collect():
        same = sum(x == y for x, y in zip(SIGNATURES[row.id1], SIGNATURES[row.id2]))
        assert row.estimate == same / N


def test_buckets(job):
    bands, rows = band_plan(N, T)
    for row in lsh.bucket_members(job.band_rows).collect():
        part = slice(row.band * rows, (row.band + 1) * rows)
        mates = [i for i, s in SIGNATURES.items() if s[part] == SIGNATURES[row.group_id][part]]
        assert (row.bucket_id, row.docs) == (min(mates), len(mates))


def test_empties_can_be_dropped(docs):
    job = NearDuplicates(docs, k=K, n=N, threshold=T, empties="drop")
    kept = {i: s for i, s in SETS.items() if s}
    assert {r.doc_id for r in job.members.collect()} == set(kept)
    assert document_pairs(job, job.true_pairs) == brute.similar(kept, T)
    with pytest.raises(ValueError):
        normalized_documents(docs, K, empties="maybe").collect()


def test_no_pairs_and_no_rows(spark):
    schema = "doc_id bigint, text string"
    lone = NearDuplicates(spark.createDataFrame([(1, "only one text here"), (2, None)], schema), k=K)
    row = lone.quality.first()
    assert (row.true_positives, row.recall, row.precision) == (0, None, None)
    none = NearDuplicates(spark.createDataFrame([], schema), k=K)
    assert none.similar.count() == none.true_pairs.count() == none.members.count() == 0
    assert none.quality.first().recall is None


def test_threshold_is_checked(docs):
    with pytest.raises(ValueError):
        NearDuplicates(docs, threshold=0.0)


def test_prefix_puts_frequent_shingles_last(spark):
    ranks = np.arange(1 << BUCKET_BITS)[::-1].copy()  # the greatest bucket is the rarest
    texts = spark.createDataFrame([(1, "abcdefg"), (2, ""), (3, None), (4, "xyzxyz")], "group_id bigint, normalized string")
    for threshold in (0.25, 0.8):
        rows = {r.group_id: r for r in prefixes_of(texts, 3, ranks, threshold).collect()}
        for i, text in ((1, "abcdefg"), (2, ""), (3, ""), (4, "xyzxyz")):
            shingles = brute.shingle_set(text, 3)
            keys = sorted((int(ranks[s & ((1 << BUCKET_BITS) - 1)]) << 32) + s for s in shingles)
            n = len(shingles)
            assert rows[i].size == n
            assert rows[i].prefix == keys[: n - math.ceil(threshold * n) + 1 if n else 0]
            assert not n or rows[i].last == rows[i].prefix[-1]


def clusters(rng, count, words=14):
    """One text with ``count`` near copies, few of which are similar to each other."""
    base = [f"v{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(count):
        own = list(base)
        for at in rng.sample(range(words), rng.choice([1, 2, 2, 3])):
            own[at] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("ids", [int, str])
@pytest.mark.parametrize("list_rows", [3, None])
def test_exact_join_of_near_copies_equals_brute_force(spark, monkeypatch, ids, list_rows):
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", list_rows or jaccard_join.LIST_ROWS)
    texts = {ids(i): t for i, t in enumerate(clusters(random.Random(1), 120) + ["", "short", "v1 v2 v3 v4 v5"])}
    kind = "bigint" if ids is int else "string"
    frame = storage.durable(spark.createDataFrame(list(texts.items()), f"group_id {kind}, normalized string"))
    got = {(r.id1, r.id2): (r.size1, r.size2, r.shared) for r in similar_pairs(frame, K, T).collect()}
    sets = {i: brute.shingle_set(t, K) for i, t in texts.items()}
    expected = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and shared / len(sets[a] | sets[b]) >= T:
            expected[a, b] = (len(sets[a]), len(sets[b]), shared)
    assert got == expected and expected


def test_pairs_that_meet_follow_those_that_are_similar(spark):
    """In a group of near copies the rows of the join grow with the similar pairs, not with the square of the group."""
    ratios = []
    for count in (500, 1000, 2000):
        texts = dict(enumerate(clusters(random.Random(count), count)))
        frame = storage.durable(spark.createDataFrame(list(texts.items()), "group_id bigint, normalized string"))
        ranks = jaccard_join.bucket_ranks(frame, K)
        prefixes = storage.durable(jaccard_join.prefix_rows(frame, K, ranks, T))
        found = jaccard_join.meetings(prefixes, T).select("id1", "id2").distinct().count()
        similar = similar_pairs(frame, K, T).count()
        ratios.append(found / similar)
        assert found <= 2 * similar
    assert max(ratios) <= 1.5 * min(ratios)


def large_texts(rng, count, words=260):
    """Near copies of some texts of more than a thousand shingles, between few words, so that chance meetings are many."""
    vocabulary = [f"w{i}" for i in range(60)]
    out = []
    for at in range(count):
        own = [rng.choice(vocabulary) for _ in range(words + 17 * at)]
        for _ in range(4):
            copy = [w for w in own if rng.random() > rng.choice([0.01, 0.05])]
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("ids", [int, str])
@pytest.mark.parametrize("threshold", [0.3, 0.8, 1.0])
def test_exact_join_of_large_sets_equals_brute_force(spark, monkeypatch, ids, threshold):
    """Sets below, around and above the size from which bitmaps alone are compared, in several parts and tiles."""
    monkeypatch.setattr(jaccard_join, "CLASS_SETS", 3)
    monkeypatch.setattr(jaccard_join, "TILE", (2, 3))
    rng = random.Random(5)
    many = large_texts(rng, 12) + large_texts(rng, 4, 100) + clusters(rng, 12, 40) + ["", "short", "v1 v2 v3 v4 v5"]
    base = "".join(rng.choices("abcdefghij", k=4 * 400 + K - 1))
    many += [base, base + "".join(rng.choices("klmnop", k=400))]  # similarity of 0.8, but for repeats
    texts = {ids(i): t for i, t in enumerate(many)}
    kind = "bigint" if ids is int else "string"
    frame = storage.durable(spark.createDataFrame(list(texts.items()), f"group_id {kind}, normalized string"))
    got = {(r.id1, r.id2): (r.size1, r.size2, r.shared) for r in similar_pairs(frame, K, threshold).collect()}
    sets = {i: brute.shingle_set(t, K) for i, t in texts.items()}
    expected = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and shared / len(sets[a] | sets[b]) >= threshold:
            expected[a, b] = (len(sets[a]), len(sets[b]), shared)
    assert got == expected
    assert expected or threshold == 1


def test_large_sets_write_no_row_per_shingle(spark, monkeypatch):
    """Every table of the exact join has some rows per text, not one per element of a prefix or chance meeting."""
    texts = dict(enumerate(large_texts(random.Random(6), 15, 900)))
    frame = storage.durable(spark.createDataFrame(list(texts.items()), "group_id bigint, normalized string"))
    written, met = [], []
    durable, met_by = jaccard_join.durable, jaccard_join.meetings

    def counted(df, name="table"):
        table = durable(df, name)
        written.append(table.count())
        return table

    def meetings(*given):
        met.append(met_by(*given).count())
        return met_by(*given)

    monkeypatch.setattr(jaccard_join, "durable", counted)
    monkeypatch.setattr(jaccard_join, "meetings", meetings)
    similar = similar_pairs(frame, K, 0.8).count()
    assert max(written) <= 10 * len(texts)
    assert sum(met) <= similar


def test_sizes_in_reach_share_a_cell(spark):
    for threshold in (0.1, 0.5, 0.8, 0.9, 1.0):
        sizes = [*range(1, 200), *range(680, 1400, 7), 1 << 20]
        pairs = [(n, int(n / threshold + 1e-9)) for n in sizes]
        every = sorted({n for pair in pairs for n in pair})
        sets = spark.createDataFrame([(n, n, bytearray(8)) for n in every], "group_id bigint, size bigint, parity binary")
        cells = {}
        for r in jaccard_join.size_classes(sets, threshold)[0].collect():
            cells.setdefault(r.group_id, set()).add((r.low, r.gap, r.a, r.b))
        assert all(cells[n] & cells[m] for n, m in pairs)


def test_a_bitmap_travels_three_times_at_any_number_of_sets(spark):
    """Many sets of like size are in no more cells than few: what is shuffled grows with the sets."""
    for count in (200, 20_000):
        sets = spark.range(count).select(
            F.col("id").alias("group_id"), (700 + F.col("id") % 700).alias("size"), F.lit(bytes(8)).alias("parity")
        )
        rows = jaccard_join.size_classes(sets, 0.8)[0]
        assert rows.count() <= 3 * count
        assert rows.groupBy("group_id", "low", "gap", "a", "b").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("size", [1, 3])
def test_every_two_sets_in_reach_meet_once(spark, monkeypatch, size):
    """Parts of a class, and classes next to each other, whatever their numbers of parts."""
    monkeypatch.setattr(jaccard_join, "CLASS_SETS", size)
    monkeypatch.setattr(jaccard_join, "CLASS_PARTS", 3)
    sizes = [*range(700, 1200, 25), *[900] * 9, 2000]
    same = bytes(8 * 16)
    rows = [(i, n, bytearray(same)) for i, n in enumerate(sizes)]
    sets = storage.durable(spark.createDataFrame(rows, "group_id bigint, size bigint, parity binary"))
    got = sorted((r.id1, r.id2) for r in jaccard_join.large_candidates(sets, 0.8).collect())
    reach = [(i, j) for i, j in itertools.combinations(range(len(sizes)), 2) if min(sizes[i], sizes[j]) >= 0.8 * max(sizes[i], sizes[j])]
    assert got == reach


@pytest.mark.parametrize("list_rows", [2, 2_000])
def test_prefixes_travel_once(spark, monkeypatch, list_rows):
    """Where the lists do not fit a broadcast, rows of prefixes are shuffled once, and the same sets meet."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    texts = list(enumerate(" ".join(rng.choices(words, k=9)) for _ in range(150)))
    texts += [(200 + i, t + " x") for i, t in texts[:40]]
    frame = storage.durable(spark.createDataFrame(texts, "group_id bigint, normalized string"))
    prefixes = storage.durable(jaccard_join.prefix_rows(frame, K, jaccard_join.bucket_ranks(frame, K), T))
    near = sorted((r.id1, r.id2) for r in jaccard_join.prefix_candidates(prefixes, T, list_rows).collect())
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 0)
    automatic = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = jaccard_join.meetings(prefixes, T, list_rows)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert near and near == sorted((r.id1, r.id2) for r in jaccard_join.prefix_candidates(prefixes, T, list_rows).collect())


def test_halves_of_the_exact_join_leave_nothing(spark):
    """Bitmaps and prefixes are gone when the candidates are written, whichever half made them."""
    texts = dict(enumerate(large_texts(random.Random(8), 4, 200) + clusters(random.Random(8), 6, 40)))
    with storage.Workspace(spark) as work:
        frame = storage.durable(spark.createDataFrame(list(texts.items()), "group_id bigint, normalized string"), "given")
        similar_pairs(frame, K, 0.8)
        left = {name.split("-")[0] for name in storage.names_below(spark, work.folder)}
    assert not left & {"sets", "prefixes", "few", "many", "placed", "dealt"}


def test_all_texts_go_when_those_of_the_groups_are_written(spark, docs):
    def tables(work):
        return [name.split("-")[0] for name in storage.names_below(spark, work.folder)]

    with storage.Workspace(spark) as work:
        job = NearDuplicates(docs, k=K, n=N, threshold=T)
        members = job.members
        found = job.texts.count()
        assert "texts" in tables(work) and "normalized" not in tables(work)
        assert found == job.groups.count() and members.count() == len(CORPUS)
        assert job.statistics.count() == len(CORPUS)  # made after it: written again
    with storage.Workspace(spark) as work:
        job = NearDuplicates(docs, k=K, n=N, threshold=T)
        before = job.statistics
        assert job.texts.count() == found and "normalized" in tables(work)
        assert before.count() == len(CORPUS)


def test_bitmaps_of_rows_equal_those_of_arrays(spark):
    rng = np.random.default_rng(7)
    sets = {i: np.unique(rng.integers(0, 1 << 32, n)) for i, n in enumerate((1, 40, 700, 5000))}
    rows = storage.durable(
        spark.createDataFrame([(i, int(x)) for i, s in sets.items() for x in s], "group_id bigint, shingle bigint")
    )
    for r in jaccard_join.long_bitmaps(rows, 0.8).collect():
        size = np.array([len(sets[r.group_id])])
        words = int(jaccard_join.wide_words(size, 0.8)[0])
        assert (r.size, bytes(r.parity)) == (size[0], jaccard_join.bitmaps(sets[r.group_id], size, words).tobytes())


def test_only_texts_of_pairs_are_shipped(spark, monkeypatch):
    texts = {i: f"some words and number {i}" for i in range(200)}
    frame = storage.durable(spark.createDataFrame(list(texts.items()), "group_id bigint, normalized string"))
    pairs = storage.durable(spark.createDataFrame([(1, 2), (2, 7)], "id1 bigint, id2 bigint"))
    joined, offered = jaccard_join.shipments, []

    def counted(wanted, texts, blocks):
        offered.append(texts.count())
        return joined(wanted, texts, blocks)

    monkeypatch.setattr(jaccard_join, "shipments", counted)
    assert jaccard_join.verify(pairs, frame, K).count() == 2
    assert offered == [3]


def test_parity_bitmaps_bound_the_difference():
    rng = np.random.default_rng(4)
    for n in (5, 60, 900):
        a = np.unique(rng.integers(0, 1 << 32, n))
        b = np.unique(np.append(a[n // 6 :], rng.integers(0, 1 << 32, n // 5)))
        apart = len(np.setxor1d(a, b))
        for u, v in ((8, 8), (8, 2), (1, 4)):
            x = jaccard_join.bitmaps(a, np.array([len(a)]), u)
            y = jaccard_join.bitmaps(b, np.array([len(b)]), v)
            got = jaccard_join.bits_apart(x, y)[0]
            assert got <= apart and got % 2 == apart % 2


def test_sets_go_once_to_each_two_blocks(spark, monkeypatch):
    """All pairs of 60 groups: with blocks of 10 groups a set is shipped some six times, not 59 times."""
    texts = {i: f"some words and number {i}" for i in range(60)}
    frame = storage.durable(spark.createDataFrame(list(texts.items()), "group_id bigint, normalized string"))
    pairs = storage.durable(spark.createDataFrame(list(itertools.combinations(range(60), 2)), "id1 bigint, id2 bigint"))
    joined, shipped = jaccard_join.shipments, []

    def counted(*given):
        shipped.append(joined(*given).count())
        return joined(*given)

    monkeypatch.setattr(jaccard_join, "shipments", counted)
    got = {(r.id1, r.id2): r.shared for r in jaccard_join.verify(pairs, frame, K, block_sets=10).collect()}
    sets = {i: brute.shingle_set(t, K) for i, t in texts.items()}
    assert got == {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(range(60), 2)}
    assert shipped[0] <= 60 * 6


def test_a_cluster_is_shipped_to_a_block_of_its_own(spark, monkeypatch):
    """100 clusters of six texts whose ids lie apart: a text goes to about one block, not to five."""
    texts = {j * 100 + i: f"cluster {i} of words and number {j}" for i in range(100) for j in range(6)}
    rows = [(a, b) for i in range(100) for a, b in itertools.combinations(range(i, 600, 100), 2)]
    frame = storage.durable(spark.createDataFrame(list(texts.items()), "group_id bigint, normalized string"))
    pairs = storage.durable(spark.createDataFrame(rows, "id1 bigint, id2 bigint"))
    joined, shipped = jaccard_join.shipments, []

    def counted(*given):
        shipped.append(joined(*given).count())
        return joined(*given)

    monkeypatch.setattr(jaccard_join, "shipments", counted)
    got = {(r.id1, r.id2): r.shared for r in jaccard_join.verify(pairs, frame, K, block_sets=20).collect()}
    sets = {i: brute.shingle_set(t, K) for i, t in texts.items()}
    assert got == {(a, b): len(sets[a] & sets[b]) for a, b in rows}
    assert shipped[0] <= 600 * 1.2


def test_long_texts_are_never_one_array(spark, monkeypatch):
    """Texts above the bound take the way of rows; results are those of arrays."""
    rng = random.Random(8)
    base = " ".join(f"w{rng.randrange(400)}" for _ in range(300))
    texts = [base, base + " and a tail", base[:-40] + "x", "short text of words", base[: len(base) // 2], "", "ab", base[5:] + " é漢"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    def results():
        job = NearDuplicates(docs, k=K, n=N, threshold=T)
        frames = (job.true_pairs, job.similar, job.verified, job.statistics, job.frequencies)
        return [sorted(map(tuple, f.collect()), key=str) for f in frames]

    expected = results()
    assert len(expected[0]) >= 6
    monkeypatch.setattr(text, "PIECE_CHARS", 100)
    cut = docs.select(F.col("doc_id"), F.col("text").alias("normalized"))
    widest = text.pieces(cut, K).select(F.max(F.size(text.shingle_set(F.col("normalized"), K)))).first()[0]
    assert widest <= 100
    assert results() == expected


def test_statistics_and_counts_hold_a_slice_of_a_batch():
    """What is held at once does not grow with the texts of a batch; the lists of 4 MB of text alone take 32 MB."""
    rng = random.Random(2)
    texts = pa.array(["".join(rng.choices("abcdefgh", k=20_000)) for _ in range(200)] + ["", None, "abcd", "é" * 9])
    tracemalloc.start()
    got = windows.set_summaries(texts, K).to_pylist()
    total = sum(int(docs.sum()) for _, docs in windows.set_counts(texts, K))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
    sets = [brute.shingle_set(t or "", K) for t in texts.to_pylist()]
    some = [dict(n=len(s), least=min(s, default=None), greatest=max(s, default=None), total=sum(s) if s else None) for s in sets]
    assert got == some
    assert total == sum(map(len, sets))


def test_a_text_of_fifty_megabytes(spark):
    """Its shingles come in pieces; no array of it is longer than a piece."""
    unit = "".join(random.Random(1).choice("abcdefgh ") for _ in range(5000))
    docs = spark.createDataFrame([(1, unit)], "doc_id bigint, unit string")
    docs = docs.select("doc_id", F.repeat("unit", 10_000).alias("normalized"))
    cut = text.pieces(docs, K).select(F.length("normalized").alias("n"))
    assert cut.agg(F.max("n"), F.count("n")).first()[:] == (text.PIECE_CHARS + K - 1, math.ceil((50_000_000 - K + 1) / text.PIECE_CHARS))
    row = set_statistics(docs, K).first()
    assert (row.n_chars, row.n_shingles) == (50_000_000, len(brute.shingle_set(unit * 2, K)))


def test_more_heavy_keys_than_the_first_tier_lists(spark, monkeypatch):
    """Two hot keys are above one in six of the heavy rows, forty others are below."""
    monkeypatch.setattr(skew, "TOP_SHARE", 6)
    rows = [("a", i) for i in range(60)] + [("b", i) for i in range(60)]
    rows += [(f"k{j}", 1000 * j + i) for j in range(40) for i in range(4)] + [("light", 1), ("light", 2)]
    many = storage.durable(spark.createDataFrame(rows, "key string, id bigint"))
    heavy = heavy_keys(many, ["key"], 3)
    assert heavy.count() == 42
    parts = {r.key: r.parts for r in skew.with_parts(many, ["key"], heavy, 3).collect()}
    assert parts == {"a": 20, "b": 20, **{f"k{j}": 2 for j in range(40)}, "light": 1}
    got = sorted((r.id1, r.id2) for r in pairs_sharing_key(many, ["key"], "id", block_rows=3).collect())
    hot = list(itertools.combinations(range(60), 2)) * 2
    rest = [p for j in range(40) for p in itertools.combinations(range(1000 * j, 1000 * j + 4), 2)]
    assert got == sorted(hot + rest + [(1, 2)])
    few = spark.createDataFrame([(k, k.upper()) for k in {key for key, _ in rows}], "key string, name string")
    plain = sorted(many.join(few, "key").collect())
    assert sorted(salted_join(many, few, ["key"], over=3).collect()) == plain


@pytest.mark.parametrize("block", [1, 2, 5, 1000])
def test_blocks_give_each_pair_once(spark, block):
    rows = [("hot", i) for i in range(23)] + [("cold", 1), ("cold", 2), ("lone", 3)]
    df = spark.createDataFrame(rows, "key string, id bigint")
    got = pairs_sharing_key(df, ["key"], "id", block_rows=block).collect()
    expected = list(itertools.combinations(range(23), 2)) + [(1, 2)]
    assert sorted((r.id1, r.id2) for r in got) == sorted(expected)


def test_rows_alone_with_their_key_stay_out_of_the_join(spark, monkeypatch):
    rows = [(f"lone{i}", i) for i in range(50)] + [("a", 1), ("a", 2), ("b", 3), ("b", 4), ("b", 5), (None, 6), (None, 7)]
    frame = storage.durable(spark.createDataFrame(rows, "key string, id bigint"))
    cut, joined = skew.with_parts, []

    def counted(rows, *given):
        joined.append(rows.count())
        return cut(rows, *given)

    monkeypatch.setattr(skew, "with_parts", counted)
    for block_rows in (None, 2):
        got = pairs_sharing_key(frame, ["key"], "id", block_rows=block_rows).collect()
        assert sorted((r.id1, r.id2) for r in got) == [(1, 2), (3, 4), (3, 5), (4, 5)]
    assert joined == [5, 5]


def test_salted_join_equals_join(spark):
    many = spark.createDataFrame([(i % 3 and "hot" or f"k{i}", i) for i in range(200)], "k string, v int")
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k0", 3)], "k string, w int")
    plain = many.join(few, "k").collect()
    assert sorted(salted_join(many, few, ["k"], over=10).collect()) == sorted(plain)
    assert [r.k for r in heavy_keys(many, ["k"], 10).collect()] == ["hot"]


def test_plans(job):
    def plan(df):
        return df._jdf.queryExecution().toString()

    assert "SortAggregate" not in plan(job.banded)
    for df in (job.similar, job.true_pairs, job.quality, job.members):
        assert "CartesianProduct" not in plan(df)
        assert "BroadcastNestedLoopJoin" not in plan(df)
        assert "BatchEvalPython" not in plan(df)
    assert "ArrowEvalPython" in plan(job.signatures)


def test_texts_are_normalised_once(docs):
    """Plans that read single texts read written ones."""
    job = NearDuplicates(docs, k=K, n=N, threshold=T)
    for df in (job.banded, job.candidates, job.similar, job.true_pairs, job.texts, job.groups):
        assert "regexp_replace" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_making_a_plan_starts_no_job(spark, docs):
    spark.sparkContext.setJobGroup("plan", "made only")
    try:
        NearDuplicates(docs, k=K).normalized  # noqa: B018
        NearDuplicates(docs, k=K).signatures  # noqa: B018
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
