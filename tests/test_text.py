import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmine.functions import minhash as mh
from sparkmine.functions.sets import jaccard, signature_similarity
from sparkmine.functions.text import normalize_text, shingle_hashes, shingle_set, shingles
from tests import brute

TEXTS = [
    "",
    "   ",
    "short",
    "exactly10c",
    "A  Quick\tbrown—fox,\njumps!",
    "Ünïcode Ｆｕｌｌ ½ under_score",
    "a\x1cb\x1fc\x85d e  f",
    "emoji 😀 in the 🎉🎊 middle of text",
    "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 letters beyond the plane 𝔞𝔟𝔠𝔡𝔢𝔣𝔤𝔥𝔦𝔧",
    "abcdefghij" * 3300,
    "'quoted' \"text\" with\ttab",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def test_normalize(texts):
    got = dict(texts.select("id", normalize_text(F.col("text"))).collect())
    assert got == {i: brute.normalize(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("k", [1, 5, 10])
def test_shingles(texts, k):
    normalized = normalize_text(F.col("text"))
    rows = texts.select(
        "id",
        shingles(normalized, k).alias("s"),
        shingle_hashes(normalized, k).alias("h"),
        shingle_set(normalized, k).alias("d"),
    ).collect()
    for row in rows:
        clean = brute.normalize(TEXTS[row.id])
        grams = [clean[i : i + k] for i in range(len(clean) - k + 1)]
        assert row.s == grams
        assert row.h == [zlib.crc32(g.encode()) for g in grams]
        assert sorted(row.d) == sorted(set(row.h))


def test_shingle_length_must_be_positive():
    with pytest.raises(ValueError):
        shingles(F.lit("x"), 0)


def test_family():
    assert mh.hash_family(1) == [(2746317214, 1181241943)]
    assert mh.hash_family(5) == mh.hash_family(100)[:5]
    with pytest.raises(ValueError):
        mh.hash_family(0)


@pytest.mark.parametrize("a", [1, 2, 2746317214, 2**32 - 1, 2**32, mh.PRIME - 1])
@pytest.mark.parametrize("b", [0, 1181241943, mh.PRIME - 1])
def test_hash_is_exact(a, b):
    values = [0, 1, 2, 15, 2**16, 2**31, 2**32 - 16, 2**32 - 1, 123456789]
    rng = np.random.default_rng(1)
    values += [int(v) for v in rng.integers(0, 2**32, 2000)]
    got = mh._hash(np.array(values, dtype=np.uint64), a, b)
    assert [int(v) for v in got] == [(a * x + b) % mh.PRIME for x in values]


def test_scaled_minima_are_exact_and_seldom_hashed(monkeypatch):
    """Also where hashes lie next to each other, at 0 and at the modulus."""
    plain, hashed = mh._hash, []
    monkeypatch.setattr(mh, "_hash", lambda x, a, b: hashed.append(len(x)) or plain(x, a, b))
    rng = np.random.default_rng(5)
    for a, b in [*mh.hash_family(5), (1, 0), (2**32 - 1, 5), (2**32, 7), (mh.PRIME - 1, 0), (mh.PRIME - 1, mh.PRIME - 1)]:
        back = pow(a, -1, mh.PRIME)
        near = [(h - b) * back % mh.PRIME for h in [*range(500), *range(mh.PRIME - 500, mh.PRIME)]]
        near = np.array([x for x in near if x < 1 << 32], np.uint64)
        values = np.concatenate([near, np.repeat(near, 2)[1:-1], rng.integers(0, 1 << 32, 1000).astype(np.uint64)])
        starts = np.concatenate([np.arange(len(near)), np.arange(len(near), 3 * len(near) - 2, 2), [3 * len(near) - 2]])
        got = mh.signatures_of(values, starts, [(a, b)])[:, 0]
        assert got.tolist() == np.minimum.reduceat(plain(values, a, b), starts).tolist()
    hashed.clear()
    mh.signatures_of(rng.integers(0, 1 << 32, 50_000).astype(np.uint64), np.arange(0, 50_000, 500), mh.hash_family(20))
    assert sum(hashed) <= 1_000


def test_signatures(texts, monkeypatch):
    monkeypatch.setattr(mh, "SLICE_VALUES", 40)  # several slices per batch
    column = mh.minhash(shingle_hashes(normalize_text(F.col("text")), 10), 20)
    got = dict(texts.coalesce(1).select("id", column).collect())
    for i, text in enumerate(TEXTS):
        expected = brute.signature(brute.shingle_set(text, 10), 20)
        assert got[i] == [mh.EMPTY if v == float("inf") else v for v in expected]


def test_signature_equals_sql_minima(texts):
    h = F.explode(shingle_set(normalize_text(F.col("text")), 10)).alias("h")
    p = mh.PRIME
    minima = [
        F.min(((F.lit(a // 65536) * F.col("h") % p) * 65536 + F.lit(a % 65536) * F.col("h") + b) % p)
        for a, b in mh.hash_family(4)
    ]
    expected = texts.select("id", h).groupBy("id").agg(F.array(*minima).alias("sig"))
    column = mh.minhash(shingle_hashes(normalize_text(F.col("text")), 10), 4).alias("sig")
    got = dict(texts.select("id", column).collect())
    for row in expected.collect():
        assert got[row.id] == row.sig


def test_band_plan():
    assert mh.band_plan(100, 0.8) == (10, 10)
    assert mh.band_plan(100, 0.5) == (20, 5)
    assert mh.band_plan(1, 0.3) == (1, 1)


def test_jaccard(spark):
    rows = [([], []), ([1], []), ([1, 2, 3], [2, 3, 4]), ([5], [5])]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    got = [r[0] for r in df.select(jaccard(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.0, 0.5, 1.0]


def test_signature_similarity(spark):
    rows = [([], []), ([1, 2], [1, 3]), ([mh.EMPTY], [mh.EMPTY])]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    got = [r[0] for r in df.select(signature_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.5, 1.0]
    bad = spark.createDataFrame([([1], [1, 2])], "a array<bigint>, b array<bigint>")
    with pytest.raises(Exception, match="same length"):
        bad.select(signature_similarity(F.col("a"), F.col("b"))).collect()


def test_estimate_error_shrinks(spark):
    x, y = set(range(0, 900)), set(range(300, 1200))
    true = brute.jaccard(x, y)
    errors = {}
    for n in (25, 1600):
        hx = np.array(sorted(zlib.crc32(str(v).encode()) for v in x), dtype=np.uint64)
        hy = np.array(sorted(zlib.crc32(str(v).encode()) for v in y), dtype=np.uint64)
        gaps = []
        for seed in range(10):
            family = mh.hash_family(n, seed)
            start = np.array([0])
            same = mh.signatures_of(hx, start, family) == mh.signatures_of(hy, start, family)
            gaps.append((same.mean() - true) ** 2)
        errors[n] = np.mean(gaps) ** 0.5
    assert errors[1600] < errors[25] / 3  # 1/sqrt(n) would be an eighth
