"""Vectorised words against regular expressions."""

import re

import numpy as np
import pyarrow as pa
import pytest

from sparkmine.llm import texts
from tests.llm.frames import ODD_TEXTS

PATTERNS = {texts.SPACES: r"[^\x20\x09-\x0D]+", texts.NON_WORD: r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("separators", PATTERNS)
@pytest.mark.parametrize("size", [7, 100, texts.CHUNK_BYTES])
def test_words(separators, size):
    said = [t if t is None else t[:3000] for t in ODD_TEXTS] * 2
    raw, offsets = texts.flat(pa.array(said))
    hashes, bounds = texts.word_hashes(raw, offsets, texts.byte_weights(separators), size)
    named = {}
    for text, a, b in zip(said, bounds[:-1], bounds[1:], strict=True):
        words = re.findall(PATTERNS[separators], lowered(text))
        assert len(words) == b - a
        for word, value in zip(words, hashes[a:b], strict=True):
            assert named.setdefault(word, value) == value
    assert len(set(named.values())) == len(named)


def test_shingles_are_sequences():
    said = ["a b c d", "b c d", "a b", "b a", "a", "", None, "a b c"]
    raw, offsets = texts.flat(pa.array(said))
    words, bounds = texts.word_hashes(raw, offsets, texts.byte_weights(texts.SPACES))
    hashes, ends = texts.shingle_hashes(words, bounds, 3)
    assert np.diff(ends).tolist() == [2, 1, 1, 1, 1, 0, 0, 1]
    sets = [hashes[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert sets[0] == [sets[7][0], sets[1][0]]
    assert len({sets[i][0] for i in (2, 3, 4, 7)}) == 4


def test_slices_cover_rows_once():
    said = pa.array(["x" * n for n in (5, 0, 100, 3, 3, 3)] + [None])
    assert list(texts.slices(said, 8)) == [(0, 2), (2, 3), (3, 5), (5, 7)]
    assert list(texts.slices(pa.array([], pa.string()))) == []
