"""Operator 3 against the tiktoken library, and the round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from sparkmine.llm import bpe
from tests.llm.frames import ODD_TEXTS, documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    with open(RANKS, "rb") as file:
        return bpe.Vocabulary.of(file.read())


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def ids_of(vocabulary, said):
    words, number, bounds = bpe.split(said, np.frombuffer(bpe.character_kinds(), np.uint8))
    flat, offsets = vocabulary.encode(words)
    return [bpe.gather(flat, offsets, number[a:b])[0].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_random_texts(vocabulary, library):
    rng = random.Random(2)
    pool = "aaabbcdet  \n\r\t'sréll7¼½　٠字漢😀​zq..--'՘\x00"
    said = ["".join(rng.choice(pool) for _ in range(rng.randrange(50))) for _ in range(2000)]
    said += ["".join(rng.choice("'sdmtrevl .a") for _ in range(rng.randrange(12))) for _ in range(3000)]
    code = [(0, 0x2FFF), (0, 0xD7FF), (0xE000, 0x10FFFF)]
    said += ["".join(chr(rng.randint(*rng.choice(code))) for _ in range(rng.randrange(30))) for _ in range(1000)]
    said += ["a" * 3000, "the" * 500, " " * 99, "ab" * 301, "I'll've 'tis ''s don'tt he'd're '", "<|endoftext|>"]
    assert ids_of(vocabulary, said) == [library.encode_ordinary(x) for x in said]


def test_words_whose_merges_go_down_in_rank():
    """ab has rank 258, but abc 257: after b and c merge late, an earlier rank turns up."""
    ranks = {bytes([i]): i for i in range(256)}
    ranks |= {b"abc": 256, b"bc": 257, b"abcabc": 258}
    lines = b"\n".join(bpe.base64.b64encode(t) + b" " + str(r).encode() for t, r in ranks.items())
    vocabulary = bpe.Vocabulary.of(lines)
    words = [b"abcabcabc", b"bcabc", b"xabcbcy", b"a"]
    library = tiktoken.Encoding("t", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    flat, offsets = vocabulary.encode(words)
    got = [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == [library.encode_ordinary(w.decode()) for w in words]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(bpe.texts, "mixed", lambda x: np.ones_like(x))
    raw = np.frombuffer(b"abcaab", np.uint8)
    first, number = bpe.distinct_words(raw, np.arange(6))
    assert [chr(raw[first[i]]) for i in number] == list("abcaab")


def test_query_shape_on_odd_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(1, ""), (None, "no id"), (5, "again"), (5, "again")]
    frame = bpe.digests(bpe.encode(documents(spark, rows).select("doc_id", "text"), RANKS), RANKS)
    assert frame.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    expected = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        coded = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((doc_id, len(ids), coded, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(expected, key=str)
    frame = bpe.encoded_digests(documents(spark, rows).select("doc_id", "text"), RANKS)
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(expected, key=str)


def test_other_columns_stay_and_small_runs(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "RUN_WORDS", 3)
    rows = [(i, f"some words {i}") for i in range(20)]
    frame = bpe.encode(documents(spark, rows), RANKS)
    assert "text" not in frame.columns and frame.columns[-1] == "token_ids"
    assert {r.doc_id: r.token_ids for r in frame.collect()} == {i: library.encode_ordinary(t) for i, t in rows}


def test_empty_table(spark):
    assert bpe.digests(bpe.encode(documents(spark, []).select("doc_id", "text"), RANKS), RANKS).collect() == []
