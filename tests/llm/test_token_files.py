"""Operator 13 against the tokenizers library, and access to single tokens."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkmine.llm import token_files
from tests.llm.frames import ODD_TEXTS, documents, sentence

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    with open(FILE, encoding="utf-8") as file:
        return token_files.Encoder(file.read())


def expected(library, rows):
    """Rows of one id may come in any order."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, rows, path, **options):
    token_files.write_files(documents(spark, rows), FILE, str(path), **options)
    frame = token_files.digests(spark, str(path))
    assert frame.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    return sorted(map(tuple, frame.collect()), key=lambda r: r[1])


ODD = [*ODD_TEXTS, "a<|endoftext|>b <|startoftext|>", "Σ ΑΣ", "é ́x", "a\x0bb\x1cc\x85d e", "don't I'LL 12345"]


def test_equals_library_on_odd_rows(spark, library, tmp_path):
    rows = [(3 * i - 5, t) for i, t in enumerate(ODD)] + [(None, "no id"), (4000, "again"), (4000, "again")]
    assert written(spark, rows, tmp_path / "f") == expected(library, rows)


def test_many_files_and_images(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "IMAGE_TOKENS", 50)
    monkeypatch.setattr(token_files, "RUN_BYTES", 300)
    monkeypatch.setattr(token_files, "WORD_BYTES", 200)
    rng = random.Random(5)
    rows = [(i, sentence(rng, rng.randrange(60)) + f" é{rng.randrange(999)}") for i in rng.sample(range(10_000), 300)]
    assert written(spark, rows, tmp_path / "f", file_bytes=2_000) == expected(library, rows)
    files = sorted((tmp_path / "f").glob("part-*"))
    assert len(files) > 5
    texts = dict(rows)
    for file in files:  # any token, from a memory map
        for held in token_files.images(np.memmap(file, np.uint8, "r")):
            whole = [*map(held.document, range(len(held.doc_ids)))]
            for doc_id, ids in zip(held.doc_ids.tolist(), whole, strict=True):
                assert ids.tolist() == [*library.encode(texts[doc_id], add_special_tokens=False).ids, 1]
            places = np.array([rng.randrange(held.tokens) for _ in range(20)])
            assert held.at(places).tolist() == np.concatenate(whole)[places].tolist()
    read = token_files.read_files(spark, str(tmp_path / "f")).select("doc_id", "token_ids").collect()
    assert {r.doc_id: r.token_ids[:-1] for r in read} == {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}


def test_empty_table(spark, tmp_path):
    assert written(spark, [], tmp_path / "f") == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\r\x0b\x0c'sŚΣ1<|endoftext>")), max_size=40)))
def test_words_apart_are_encoded_as_the_whole(library, encoder, said):
    ids, ends = encoder.encode([x.encode() for x in said])
    starts = [0, *ends[:-1]] if len(ends) else []
    got = [ids[a:b].tolist() for a, b in zip(starts, ends, strict=True)]
    assert got == [library.encode(x, add_special_tokens=False).ids for x in said]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=2000), st.data())
def test_image_round_trip(ids, data):
    held = token_files.Image(np.frombuffer(token_files.image([None], np.array(ids, np.uint32), np.array([len(ids)])), np.uint8))
    assert held.document(0).tolist() == ids and not held.known[0]
    if ids:
        a, b = sorted(data.draw(st.tuples(*[st.integers(0, len(ids))] * 2)))
        assert held.between(a, b).tolist() == ids[a:b]
        places = np.array(data.draw(st.lists(st.integers(0, len(ids) - 1), min_size=1, max_size=30)))
        assert held.at(places).tolist() == [ids[i] for i in places]


def test_texts_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Texts are encoded where they are read: what is sorted for the files are ids."""
    seen = []
    kind = type(spark.range(0))
    mapped = kind.mapInArrow

    def noted(self, *args, **options):
        made = mapped(self, *args, **options)
        seen.append(made._jdf.queryExecution().optimizedPlan().toString())
        return made

    monkeypatch.setattr(kind, "mapInArrow", noted)
    rows = [(i, f"text {i}") for i in range(50)]
    token_files.write_files(documents(spark, rows), FILE, str(tmp_path / "f"), file_bytes=100)
    with_text = [plan for plan in seen if "MapInArrow" in plan and not re.search(r"Repartition|Sort", plan)]
    assert with_text, "the tokenizer runs on sorted texts"
    assert len(list((tmp_path / "f").glob("part-*"))) > 3


def test_rows_of_one_id_are_dealt_to_many_files(spark, library, tmp_path):
    rows = [(i % 2 or None, f"w{i} x{i * i}") for i in range(400)]
    token_files.write_files(documents(spark, rows), FILE, str(tmp_path / "f"), file_bytes=400)
    sizes = [sum(len(h.doc_ids) for h in token_files.images(np.fromfile(f, np.uint8))) for f in (tmp_path / "f").glob("part-*")]
    assert sum(sizes) == 400 and len(sizes) > 5 and max(sizes) < 200
    read = token_files.read_files(spark, str(tmp_path / "f")).orderBy("file", "start").collect()
    assert [r.doc_id for r in read] == [None] * 200 + [1] * 200
    said = {(i % 2 or None, tuple(library.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(t for _, t in rows)}
    assert {(r.doc_id, tuple(r.token_ids[:-1])) for r in read} == said


def test_ids_of_more_than_two_bytes():
    ids, ends = np.array([1, 65_535, 7, 65_536, 2**32 - 1], np.uint32), np.array([2, 2, 3, 5])
    for n in (3, 4):  # without and with large ids
        low, high = token_files.halves(ids[: ends[n - 1]], ends[:n])
        assert (high.null_count == n) == (n == 3)
        back, at = token_files.whole_ids(low, high)
        assert back.tolist() == ids[: ends[n - 1]].tolist() and at.tolist() == ends[:n].tolist()
