"""Operator 9 against the tokenizers library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, normalizers

from sparkmine.llm import token_count
from tests.llm.frames import ODD_TEXTS, documents

FILE = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces, unknown, byte_fallback=True):
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=unknown, byte_fallback=byte_fallback))
    tokenizer.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return tokenizer


@pytest.fixture(scope="module")
def vocabulary():
    return token_count.read_pieces(FILE)


def said():
    rng = random.Random(3)
    pieces = ["the", "and", "<unk>", "<0x0A>", " ", "  ", "字", "😀", "\n", "x", "﷽", "▁", "ѣ", "\x00", "ing", ".", "𝒜"]
    out = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(1500)]
    return out + [t for t in ODD_TEXTS if t] + ["", " ", "   ", "▁", "a" * 40_000]


def test_query_on_odd_rows(spark, vocabulary):
    texts = said()
    rows = [(i, t) for i, t in enumerate(texts)] + [(-1, None), (None, "no id"), (7, "twice"), (7, "twice")]
    result = token_count.count_tokens(documents(spark, rows).select("doc_id", "text"), FILE).collect()
    tokenizer = library(*vocabulary)
    expected = sorted(str((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids))) for i, t in rows)
    assert sorted(str((r.doc_id, r.n_tokens)) for r in result) == expected


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_ties_and_unknown_characters(byte_fallback):
    """Whole-number scores with many equally good ways."""
    rng = random.Random(5)
    pieces = [("<unk>", 0.0)] + [(p, float(-rng.randrange(1, 4))) for p in ["▁", "a", "b", "ab", "ba", "aab", "▁a", "bb", "aba", "▁ab", "zz", "az"]]
    if byte_fallback:
        pieces += [(f"<0x{i:02X}>", -9.0) for i in range(256)]
    model = token_count.Unigram(pieces, 0, byte_fallback)
    tokenizer = library(pieces, 0, byte_fallback)
    words = ["▁" + "".join(rng.choice("aabbzé") for _ in range(rng.randrange(12))) for _ in range(2000)]
    _, counts = model.count(words)
    expected = [len(tokenizer.encode(w[1:], add_special_tokens=False).ids) if len(w) > 1 else 1 for w in words]
    assert counts.tolist() == expected


def test_small_runs(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(token_count, "TOGETHER", 3)
    tokenizer = library(*vocabulary)
    model = token_count.Unigram(*vocabulary)
    words = [w.replace(" ", "▁") for w in (" of", " strange", " wörds", " 12345", "\n\n")]
    _, counts = model.count(words)
    assert counts.tolist()[:4] == [len(tokenizer.encode(w[1:], add_special_tokens=False).ids) for w in words[:4]]


def test_pieces_that_would_join_words():
    with pytest.raises(ValueError):
        token_count.Unigram([("<unk>", 0.0), ("a▁b", -1.0)], 0)


def test_empty_table(spark):
    assert token_count.count_tokens(documents(spark, []).select("doc_id", "text"), FILE).collect() == []
