"""Token ids in files of directly addressable codes: any token is read without decoding others.

An id is split into bytes, the least first. Level 0 has the first byte of each id, level k the next byte of those that have
one. Beside each level lies a bitmap of which bytes go on, with a directory of the bits set before every 512th, so the
place of an id's next byte is the number of set bits before its own: one directory entry and at most eight words.

A file is a sequence of images, each followed by ``AFTER``. An image is a header, the ids of its documents, where each
begins, and the levels; all numbers are little-endian and all parts begin at multiples of 8 bytes of the image. Documents lie
in files and images in rising order of doc_id and are never cut. Spark's own writer puts the files in place, so a
task that runs twice leaves one file, on any store that Spark can write.
"""

from __future__ import annotations

import bisect
import itertools
import json
import math
import os
import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmine.llm import texts
from sparkmine.llm.tables import Scratch

# Fixed value: the id that ends a document.
END_ID = 1

MAGIC = b"DACIMG01"
HEADER = "<8sQQQQ"  # magic, bytes of the image, documents, tokens, levels
HEADER_BYTES = struct.calcsize(HEADER)
AFTER = "-ENDIMG\n"  # after each image; as long as a word, so the next one is aligned, too
SUPERBLOCK = 512
IMAGE_TOKENS = 1 << 20  # an image is closed when it has as many
FILE_BYTES = 32 << 20  # bytes of text in a file, about; a file is read whole
LEAST_FILE_BYTES = 2 << 20  # files may be as small to keep all cores busy
RUN_BYTES = 2 << 20  # bytes of text encoded together
WORD_BYTES = 10 << 20  # bytes of distinct words that a worker remembers
LINE = 100  # words given to the tokenizer in a line
LINES = 50  # lines given to it together; what it returns takes hundreds of bytes a token
READ_TOKENS = 1 << 17  # tokens read back together
KEYS_A_FILE = 100  # keys sampled for each file, to deal documents by

# Words of which the pattern's parts are known: runs of these letters, single digits, runs of other ASCII characters. Quotes
# may split letters off, and an angle bracket may begin a special token.
PLAIN = re.compile(r"[!-&(-;=-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def level_bytes(ids: np.ndarray) -> list[bytes]:
    """Number of entries, bytes, bitmap and directory of each level."""
    out = []
    while True:
        more = ids >= 256
        bits = np.packbits(more, bitorder="little").tobytes()
        bits += bytes(-len(bits) % (SUPERBLOCK // 8))
        counts = np.bitwise_count(np.frombuffer(bits, "<u8")).reshape(-1, SUPERBLOCK // 64).sum(axis=1, dtype=np.uint64)
        before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(counts, dtype=np.uint64)])
        body = (ids & np.uint32(255)).astype(np.uint8).tobytes()
        out.append(struct.pack("<Q", len(ids)) + padded(body) + bits + before.astype("<u8").tobytes())
        if not more.any():
            return out
        ids = ids[more] >> np.uint32(8)


def image(doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray) -> bytes:
    """An image of documents, the i-th of which ends before ``ids[ends[i]]``."""
    known = np.array([d is not None for d in doc_ids], np.uint8)
    named = np.array([d or 0 for d in doc_ids], "<i8")
    starts = np.concatenate([[0], ends]).astype("<u8")
    levels = level_bytes(ids.astype(np.uint32))
    body = b"".join([named.tobytes(), padded(known.tobytes()), starts.tobytes(), *levels])
    return struct.pack(HEADER, MAGIC, HEADER_BYTES + len(body), len(doc_ids), len(ids), len(levels)) + body


class Level:
    def __init__(self, data: np.ndarray, at: int):
        self.size = int(data[at : at + 8].view("<u8")[0])
        at += 8
        self.bytes = data[at : at + self.size]
        at += -(-self.size // 8) * 8
        blocks = -(-self.size // SUPERBLOCK)
        self.words = data[at : at + blocks * SUPERBLOCK // 8].view("<u8")
        at += blocks * SUPERBLOCK // 8
        self.before = data[at : at + 8 * (blocks + 1)].view("<u8")
        self.end = at + 8 * (blocks + 1)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Bits set before each place."""
        block, word = at // SUPERBLOCK, at // 64
        out = self.before[block].astype(np.int64)
        if not len(self.words):
            return out
        for i in range(SUPERBLOCK // 64):
            other = np.minimum(block * (SUPERBLOCK // 64) + i, len(self.words) - 1)
            out += np.where(block * (SUPERBLOCK // 64) + i < word, np.bitwise_count(self.words[other]), 0)
        inner = (np.uint64(1) << (at % 64).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(self.words[np.minimum(word, len(self.words) - 1)] & inner)

    def goes_on(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1


class Image:
    """An image in an array of bytes, which may be a memory map: only what is asked for is touched."""

    def __init__(self, data: np.ndarray, at: int = 0):
        magic, self.length, docs, self.tokens, levels = struct.unpack(HEADER, data[at : at + HEADER_BYTES].tobytes())
        if magic != MAGIC:
            raise ValueError("not an image of token ids")
        data = data[at : at + self.length]
        if data.ctypes.data % 8:
            data = np.array(data)  # a buffer that begins at any byte
        at = HEADER_BYTES
        self.doc_ids = data[at : at + 8 * docs].view("<i8")
        at += 8 * docs
        self.known = data[at : at + docs]
        at += -(-docs // 8) * 8
        self.starts = data[at : at + 8 * (docs + 1)].view("<u8")
        at += 8 * (docs + 1)
        self.levels = []
        for _ in range(levels):
            self.levels.append(Level(data, at))
            at = self.levels[-1].end

    def at(self, places: np.ndarray) -> np.ndarray:
        """The tokens at any places."""
        out = np.zeros(len(places), np.uint32)
        which = np.arange(len(places))
        for k, level in enumerate(self.levels):
            out[which] |= level.bytes[places].astype(np.uint32) << np.uint32(8 * k)
            more = level.goes_on(places)
            which, places = which[more], level.rank(places[more])
            if not len(which):
                break
        return out

    def between(self, begin: int, end: int) -> np.ndarray:
        """The tokens from ``begin`` to before ``end``."""
        out = np.zeros(end - begin, np.uint32)
        which = np.arange(end - begin)
        for k, level in enumerate(self.levels):
            if not len(which):
                break
            out[which] |= level.bytes[begin:end].astype(np.uint32) << np.uint32(8 * k)
            words = level.words[begin // 64 : -(-end // 64)]
            bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), bitorder="little")
            which = which[bits[begin % 64 : begin % 64 + end - begin] == 1]
            begin, end = level.rank(np.array([begin, end])).tolist()
        return out

    def document(self, i: int) -> np.ndarray:
        """The tokens of the i-th document."""
        return self.between(int(self.starts[i]), int(self.starts[i + 1]))


def images(data: np.ndarray) -> Iterator[Image]:
    """The images of a file, given as its bytes or a memory map of it."""
    at = 0
    while at < len(data):
        found = Image(data, at)
        yield found
        at += found.length + len(AFTER)


class Numbers(dict):
    """A number for each key, in the order in which they are first looked up; ``fresh`` has the new ones."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number

    def of(self, keys: list[list[bytes]]) -> tuple[np.ndarray, list[bytes]]:
        """Numbers of all keys, and the new keys."""
        found = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(keys)), np.int64, sum(map(len, keys)))
        fresh, self.fresh = self.fresh, []
        return found, fresh


class Runs:
    """Numbered runs of ids."""

    def __init__(self):
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs ``which`` one after another, and 0 and where each ends."""
        starts = self.ends[which]
        counts = self.ends[which + 1] - starts
        ends = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[np.repeat(starts - ends[:-1], counts) + np.arange(ends[-1])], ends


def flat_ids(coded: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some encodings and how many each has."""
    lists = [x.ids for x in coded]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.uint32, counts.sum()), counts


def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of all parts."""
    ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    for some, each in parts:
        ids.append(some)
        counts.append(each)
    return np.concatenate(ids), np.concatenate(counts)


class Encoder:
    """Ids of whole texts. Words between ASCII white space are encoded on their own and remembered.

    That gives the tokenizer's ids if white space, which it drops, always parts tokens: its normaliser and its pattern never
    look across it. New words are given to the tokenizer many in a line. If how many parts the pattern makes of a word can be
    told, the ends of parts, which the vocabulary marks, tell its ids from its neighbours'; other words go singly.
    """

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(source)
        suffix = json.loads(source)["model"].get("end_of_word_suffix")
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ending = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.ending[[i for name, i in names.items() if suffix and name.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.words, self.size, self.known = Numbers(), 0, Runs()

    def given(self, lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids that the tokenizer gives for each line, and how many; it gets ``size`` lines at once."""
        runs = [lines[i : i + size] for i in range(0, len(lines), size)]
        return joined([flat_ids(self.tokenizer.encode_batch_fast(run, add_special_tokens=False)) for run in runs])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and how many each has."""
        parts = np.array([len(PARTS.findall(w)) if PLAIN.fullmatch(w) else 0 for w in words], np.int64)
        plain = np.flatnonzero(parts)
        lines = [" ".join([words[i] for i in plain[j : j + LINE]]) for j in range(0, len(plain), LINE)]
        ids, _ = self.given(lines, LINES)
        ends = np.flatnonzero(self.ending[ids]) + 1
        last = np.cumsum(parts[plain])
        if len(ends) != parts.sum():  # a tokenizer that marks no ends
            parts[:], plain, ids, ends, last = 0, plain[:0], ids[:0], ends[:0], last[:0]
        counts = np.zeros(len(words), np.int64)
        counts[plain] = np.diff(ends[last - 1], prepend=0)
        odd = np.flatnonzero(parts == 0)
        odd_ids, counts[odd] = self.given([words[i] for i in odd], LINE * LINES)
        out = np.empty(counts.sum(), np.uint32)
        in_line = np.repeat(parts > 0, counts)
        out[in_line], out[~in_line] = ids, odd_ids
        return out, counts

    def encode(self, said: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and, for each, where its ids end."""
        if self.size > WORD_BYTES:
            self.forget()
        split = [text.split() for text in said]
        which, fresh = self.words.of(split)
        if fresh:
            self.size += sum(map(len, fresh))
            self.known.add(*self.encode_words([w.decode() for w in fresh]))
        flat, ends = self.known.take(which)
        return flat, ends[np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` after the ids of each text."""
    out = np.full(len(ids) + len(ends), end_id, np.uint32)
    kept = np.ones(len(out), bool)
    after = ends + np.arange(1, len(ends) + 1)
    kept[after - 1] = False
    out[kept] = ids
    return out, after


def halves(ids: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The lower and the upper 16 bits of the ids of each document as bytes; the upper are null if they are 0 in all."""
    offsets = pa.py_buffer(np.concatenate([[0], 2 * ends]).astype(np.int32))

    def column(values: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(values.astype("<u2"))])

    high = ids >> np.uint32(16)
    return column(ids & np.uint32(0xFFFF)), column(high) if high.any() else pa.nulls(len(ends), pa.binary())


def whole_ids(low: pa.Array, high: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`halves` was given."""
    ids = np.frombuffer(b"".join(low.to_pylist()), "<u2").astype(np.uint32)
    sizes = pc.binary_length(low).to_numpy() // 2
    if high.null_count < len(high):
        upper = [x if x is not None else bytes(2 * n) for x, n in zip(high.to_pylist(), sizes.tolist(), strict=True)]
        ids |= np.frombuffer(b"".join(upper), "<u2").astype(np.uint32) << np.uint32(16)
    return ids, np.cumsum(sizes, dtype=np.int64)


def key_bounds(keys: DataFrame, count: int) -> list[tuple]:
    """Where to cut ``keys(doc_id, hash, size)`` into ``count`` ranges of about the same size, from a few sampled keys a range."""
    rows = keys.count()
    some = keys.sample(min(1.0, KEYS_A_FILE * count / max(rows, 1)), seed=1).collect() if count > 1 else []
    some = sorted((sort_key(r.doc_id, r.hash), r.size) for r in some)
    ends = np.cumsum([size for _, size in some], dtype=np.int64)
    at = np.searchsorted(ends, np.arange(1, count) * (ends[-1] / count)) if some else []
    return sorted({some[i][0] for i in at})


def sort_key(doc_id: int | None, hashed: int) -> tuple:
    return doc_id is not None, doc_id or 0, hashed


def coded(rows: DataFrame, tokenizer_file: str, end_id: int, bounds: list[tuple]) -> DataFrame:
    """``doc_id, hash, range, low, high`` of ``rows(doc_id, hash, text)``: number of the range, and the ids as :func:`halves`."""
    shared = rows.sparkSession.sparkContext.broadcast({"file": Path(tokenizer_file).read_text(encoding="utf-8")})

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_by_worker = shared.value  # outlives the task, so the next one knows this one's words
        if "encoder" not in held_by_worker:
            held_by_worker["encoder"] = Encoder(held_by_worker["file"])
        encoder = held_by_worker["encoder"]
        for whole in batches:
            for i, j in texts.slices(whole.column("text"), RUN_BYTES):
                raw, offsets = texts.flat(whole.column("text").slice(i, j - i))
                said = [raw[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                made = halves(*with_end(*encoder.encode(said), end_id))
                keys = [whole.column(c).slice(i, j - i) for c in ("doc_id", "hash")]
                each = zip(*(c.to_pylist() for c in keys), strict=True)
                ranges = pa.array([bisect.bisect_right(bounds, sort_key(*key)) for key in each], pa.int32())
                yield pa.RecordBatch.from_arrays([*keys, ranges, *made], names=["doc_id", "hash", "range", "low", "high"])

    return rows.select("doc_id", "hash", "text").mapInArrow(code, "doc_id long, hash long, range int, low binary, high binary")


def write_files(
    documents: DataFrame, tokenizer_file: str, path: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES
) -> None:
    """Write the ids of ``documents(doc_id, text)`` below ``path``, files and documents in rising order of doc_id.

    Special tokens are not added; ``end_id`` ends each document. A null text has no other id, like an empty one. A null
    doc_id comes first and is kept as null; rows of one id are documents of their own, in the order of a hash of the
    text. Other columns are ignored. An empty table gives no images. ``tokenizer_file`` is read on the driver. A document is
    held whole by the task that encodes it. Texts are encoded where they are read; only ids are dealt and sorted, at two
    bytes each unless they need more.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    size = (F.octet_length("text") + 1).cast("long").alias("size")
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    enough = min(math.ceil(total / LEAST_FILE_BYTES), 2 * documents.sparkSession.sparkContext.defaultParallelism)
    count = max(1, enough, math.ceil(total / file_bytes))
    bounds = key_bounds(rows.select("doc_id", "hash", size), count)
    ids = coded(rows, tokenizer_file, end_id, bounds)
    dealt = ids.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions("doc_id", "hash")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        ends: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal held
            made = image(doc_ids, np.concatenate(parts), np.concatenate(ends))
            for column in (doc_ids, parts, ends):
                column.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["image"])

        for whole in batches:
            for i, j in texts.slices(whole.column("low"), RUN_BYTES):
                batch = whole.slice(i, j - i)
                ids, after = whole_ids(batch.column("low"), batch.column("high"))
                doc_ids += batch.column("doc_id").to_pylist()
                parts.append(ids)
                ends.append(after + held)
                held += len(ids)
                if held >= IMAGE_TOKENS:
                    yield close()
        if doc_ids:
            yield close()

    made = dealt.select("doc_id", "low", "high").mapInArrow(gather, "image binary")
    made.select(F.col("image").cast("string")).write.option("lineSep", AFTER).text(path)  # the bytes as they are


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, doc_id, token_ids`` of all documents: number of the file, and where in it the ids start."""
    return _files(spark, path, "token_ids array<long>", lambda ids: [pa.array(list(ids), pa.list_(pa.int64()))])


def _files(spark: SparkSession, path: str, columns: str, make) -> DataFrame:
    """``file, start, doc_id`` and what ``make`` gives for the ids of some documents, as ``columns``."""
    schema = f"file long, start long, doc_id long, {columns}"
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                number = int(re.search(r"part-(\d+)[^/]*$", name.as_py())[1])
                before = 0
                for held in images(np.frombuffer(content.as_buffer(), np.uint8)):
                    starts, i = held.starts.astype(np.int64), 0
                    while i < len(held.doc_ids):
                        j = max(i + 1, int(np.searchsorted(starts, starts[i] + READ_TOKENS, side="right")) - 1)
                        ids = held.between(int(starts[i]), int(starts[j]))
                        each = np.split(ids, starts[i + 1 : j] - starts[i])
                        made = [
                            pa.array(np.full(j - i, number)),
                            pa.array(before + starts[i:j]),
                            pa.array(held.doc_ids[i:j].astype(np.int64), mask=held.known[i:j] == 0),
                        ]
                        yield pa.RecordBatch.from_arrays([*made, *make(each)], names=names)
                        i = j
                    before += held.tokens

    files = spark.read.format("binaryFile").load(path).filter(F.col("length") > 0)
    return files.select("path", "content").mapInArrow(read, schema)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, read from the files below ``path``.

    ``start`` counts the ids of all documents before, over all files.
    """

    def make(ids: list[np.ndarray]) -> list[pa.Array]:
        sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
        return [pa.array([len(x) for x in ids], pa.int64()), pa.array(sums, pa.int64())]

    found = Scratch(spark).write("found", _files(spark, path, "n_tokens long, ids_crc32 long", make))
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))  # one row per file
    before = F.sum("tokens").over(Window.orderBy("file")) - F.col("tokens")
    offsets = totals.select("file", before.alias("before"))
    return found.join(offsets, "file").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
