"""Operator 11 against plain counting in whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from sparkmine.llm import divergence
from tests.llm.frames import ODD_TEXTS, WORDS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def frame(spark, rows):
    """``rows`` of (lang, source, text) with columns whose names the operator uses itself."""
    made = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    clashing = {c: "x" for c in "term count docs total kept rows cell blocks value rank part item".split()}
    return made.selectExpr("*", *[f"'{v}' as {c}" for c, v in clashing.items()])


def brute(rows, least=3, ranks=200):
    held, said = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        held[lang].update(terms.keys())
        said[lang, source].update(terms)
    out = []
    for lang in held:
        kept = [t for t, n in held[lang].items() if n >= least]
        groups = [key for key in said if key[0] == lang]
        whole = Counter()
        for key in groups:
            whole.update(said[key])

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {key: shares(said[key]) for key in groups}, shares(whole)
        for key in groups:
            pairs = [
                (-sum((p[key][t] - p[other][t]) ** 2 // p[other][t] for t in kept), other[1].encode())
                for other in groups
                if other != key
            ]
            over = [t for t in kept if said[key][t] and p[key][t] > q[t]]
            terms = [(-((p[key][t] - q[t]) ** 2 // q[t]), t.encode()) for t in over]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out += [(*key, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(found, 1)]
    return sorted(out)


def made(rng, count):
    rows = []
    for _ in range(count):
        source = f"s{int(rng.random() ** 2 * 7)}"
        words = [rng.choice(WORDS) if rng.random() < 0.7 else f"{rng.choice(WORDS)}É{'x' * rng.randrange(30)}" for _ in range(40)]
        rows.append((rng.choice(["en", "de", None]), source, rng.choice([" ", "-", "\n7"]).join(words)))
    return rows


def test_equals_brute_force(spark):
    rng = random.Random(11)
    rows = made(rng, 150) + [("en", "s0", t) for t in ODD_TEXTS] * 3
    rows += [(None, None, None), ("lone", "a", "word"), ("lone", "b", None), ("en", "only empty", ""), ("en", "s1", "the " * 4000)]
    expected = brute(rows)
    assert sorted(map(tuple, divergence.audit(frame(spark, rows)).collect())) == expected
    small = divergence.audit(frame(spark, rows), cell_rows=7, block=2)
    assert sorted(map(tuple, small.collect())) == expected
    few = divergence.audit(frame(spark, rows), least_documents=2, ranks=3)
    assert sorted(map(tuple, few.collect())) == brute(rows, 2, 3)


def test_texts_beyond_a_run_count_once(spark):
    rows = [("en", f"s{i % 2}", "Alpha beta " * 300 + "y" * 90 + f" gamma{i}") for i in range(4)] + [("en", "s2", "alpha delta")] * 3
    runs = divergence.group_counts(frame(spark, rows), run_bytes=64).filter("term is not null")
    whole = divergence.group_counts(frame(spark, rows)).filter("term is not null")
    assert sorted(map(tuple, runs.collect())) == sorted(map(tuple, whole.collect()))
    found = {(r.source, r.term): (r["count"], r.docs) for r in runs.collect()}
    assert found["s0", "alpha"] == (600, 2) and found["s2", "delta"] == (3, 3) and found["s1", "y" * 90] == (2, 2)


def test_empty_table(spark):
    assert divergence.audit(frame(spark, [])).collect() == []


def test_order_is_by_bytes_whatever_the_length():
    rng = random.Random(3)
    terms = ["".join(rng.choice("abÿ漢") for _ in range(rng.randrange(1, 12))) for _ in range(2000)]
    raw = np.frombuffer(" ".join(terms).encode(), np.uint8)
    found = Counter()
    ends = np.array([0, len(raw)])
    for _, names, counts, docs in divergence.count_terms(raw, ends, np.zeros(1, np.int64), 1, divergence.lower_table()):
        found.update(dict(zip(names.to_pylist(), counts.tolist(), strict=True)))
        assert isinstance(names, pa.Array) and set(docs.tolist()) == {1}
    assert found == Counter(terms)


def test_shares_are_exact():
    counts = [0, 1, 10**6, 3 * 10**12, 9 * 10**15 // 2]
    totals, kept = [n + 12_345 for n in counts], [1, 7, 10**5, 10**6, 10**6]
    got = divergence.shares(*(np.array(x, np.int64) for x in (counts, totals, kept)))
    assert got.tolist() == [1 + 10**9 * (c + 1) // (n + v) for c, n, v in zip(counts, totals, kept, strict=True)]


def test_share_column_equals_array(spark):
    rows = [(5, 100, 9), (0, 0, 1), (10**12, 10**13, 10**6)]
    made_frame = spark.createDataFrame(rows, "c long, n long, v long")
    from pyspark.sql import functions as F

    got = [r[0] for r in made_frame.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 1) // (n + v) for c, n, v in rows]
