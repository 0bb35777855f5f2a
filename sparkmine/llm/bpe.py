"""Byte-level BPE by replaying the merges over the distinct words of many texts at once.

The words of a run of texts are laid out as one array of tokens with links to their neighbours. An
inverted index leads from the rank of a token pair to the positions where it stands. Ranks are taken from
least to greatest; all positions of a rank merge together, and only the pairs beside them are looked up
anew. A merge nearly always creates pairs of greater rank. In a word where it does not, the order of
merges within the word differs from the order of ranks, and that word is encoded on its own.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sparkmine.llm import texts

RUN_WORDS = 2_000_000  # words of texts held at once, as numbers
RUN_BYTES = 2 << 20  # bytes of distinct words merged at once
GATHERED = 200_000  # tokens decoded at once
DIGESTS = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}


# Kinds of characters, and the endings split off after an apostrophe.
OTHER, LETTER, NUMBER, SPACE = range(4)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def character_kinds() -> bytes:
    """The kind of each code point as tiktoken's own matcher sees it, whose Unicode tables are its own."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    code_points = np.array([c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF], np.uint32)
    every = code_points.astype("<u4").tobytes().decode("utf-32-le")
    kinds = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        matcher = tiktoken.Encoding("kind", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(matcher.encode_ordinary(every)).decode()
        kinds[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return kinds.tobytes()


def word_starts(codes: np.ndarray, begins: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the words of the byte-level pattern start, in texts that begin at ``begins``.

    A word is an ending after an apostrophe that begins a word; a run of letters, of numbers or of other
    characters, with one blank before it if there is one; or a run of white space, whose last character
    is left to the next word.
    """
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    kind = kinds[codes]
    fresh = np.zeros(n + 3, bool)  # a text begins here, or all ends
    fresh[begins] = True
    fresh[n] = True
    start = fresh[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = kind == SPACE
    last = blank & ~fresh[1 : n + 1]  # white space before a word of the same text
    last[:-1] &= ~blank[1:]
    start |= last
    joins = last & (codes == 0x20)
    start[1:] &= ~joins[:-1]
    ahead = np.concatenate([codes, np.zeros(2, codes.dtype)])
    quote = np.flatnonzero(start & (codes == ord("'")))
    quote = quote[~fresh[quote + 1]]
    taken = np.zeros(len(quote), np.int64)
    for ending in ENDINGS:
        fits = ahead[quote + 1] == ord(ending[0])
        if len(ending) == 2:
            fits &= (ahead[quote + 2] == ord(ending[1])) & ~fresh[quote + 2]
        taken[fits & (taken == 0)] = len(ending)
    quote, taken = quote[taken > 0], taken[taken > 0]
    start[quote + 1] = False
    behind = quote + 1 + taken
    behind = behind[behind < n]
    start[behind] |= kind[behind] == LETTER  # the rest of the run of letters is a word
    return np.flatnonzero(start)


def distinct_words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First occurrence of each distinct word, and for each word the number of its distinct one.

    Found by 64-bit hashes; should two unequal words share one, all words are compared as bytes.
    """
    ends = np.append(starts[1:], len(raw))
    sizes = ends - starts
    place = np.arange(len(raw)) - np.repeat(starts, sizes)
    powers = np.full(int(sizes.max(initial=1)), 0x9E3779B97F4A7C15, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    value = texts.mixed(np.arange(1, 257, dtype=np.uint64))[raw] * powers[place]
    _, first, number = np.unique(np.add.reduceat(value, starts), return_index=True, return_inverse=True)
    same = sizes[first][number] == sizes
    if same.all() and (raw[np.repeat(starts[first][number], sizes) + place] == raw).all():
        return first, number
    words = np.array([raw[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], object)
    _, first, number = np.unique(words, return_index=True, return_inverse=True)
    return first, number


def split(texts_said: list[str], kinds: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of all texts, the word number at each place, and the offsets of each text's."""
    lengths = np.array([len(x) for x in texts_said], np.int64)
    joined = "".join(texts_said)
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    raw = np.frombuffer(joined.encode(), np.uint8)
    begins = np.cumsum(lengths) - lengths
    starts = word_starts(codes, begins[lengths > 0], kinds)
    bounds = np.searchsorted(starts, np.append(begins, len(codes)))
    if not len(starts):
        return [], np.empty(0, np.int64), bounds
    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    at = (np.cumsum(width) - width)[starts]
    first, number = distinct_words(raw, at)
    ends = np.append(at[1:], len(raw))
    return [raw[a:b].tobytes() for a, b in zip(at[first], ends[first], strict=True)], number, bounds


def vocabulary_parts(file: bytes, merges: bool = True) -> tuple:
    """What a :class:`Vocabulary` is made of, as bytes and arrays, from a tokenizer file (base64 token and rank per line).

    ``merges`` is whether to make the table of pairs, which only encoding needs.
    """
    tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}
    size = max(tokens.values()) + 1
    by_rank = [b""] * size
    for token, rank in tokens.items():
        by_rank[rank] = token
    pairs = {}
    for token, rank in tokens.items() if merges else ():
        for i in range(1, len(token)):
            a, b = tokens.get(token[:i]), tokens.get(token[i:])
            if a is not None and b is not None:
                pairs[a * size + b] = rank
    keys = sorted(pairs)
    lengths = np.array([len(t) for t in by_rank], np.int64)
    return b"".join(by_rank), lengths, np.array(keys, np.int64), np.array([pairs[k] for k in keys], np.int32)


class Vocabulary:
    """The tokens by rank, and the rank that each pair of tokens merges to."""

    def __init__(self, joined: bytes, lengths: np.ndarray, pair_keys: np.ndarray, pair_ranks: np.ndarray):
        self.lengths, self.pair_keys, self.pair_ranks = lengths, pair_keys, pair_ranks
        self.size = len(lengths)
        self.begins = np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(joined, np.uint8)
        alone = np.flatnonzero(lengths == 1)
        self.single = np.zeros(256, np.int32)
        self.single[self.bytes[self.begins[alone]]] = alone

    @classmethod
    def of(cls, file: bytes, merges: bool = True) -> Vocabulary:
        return cls(*vocabulary_parts(file, merges))

    @functools.cached_property
    def ranks(self) -> dict[bytes, int]:
        joined, ends = self.bytes.tobytes(), self.begins + self.lengths
        return {joined[a:b]: r for r, (a, b) in enumerate(zip(self.begins.tolist(), ends.tolist(), strict=True)) if b > a}

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, -1 if none; a token of -1 makes none."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], np.int32(-1))

    def one_word(self, word: bytes) -> list[int]:
        """Tokens of one word: always the leftmost pair of least rank."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b, self.size), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(found)
            if rank == self.size:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, none of them empty, and the offsets of each word's."""
        sizes = np.array([len(w) for w in words], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        token, odd = self._replay(np.frombuffer(b"".join(words), np.uint8), bounds)
        alive = token >= 0
        counts = np.add.reduceat(alive, bounds[:-1]) if len(words) else sizes
        flat = token[alive]
        if not len(odd):
            return flat, np.concatenate([[0], np.cumsum(counts)])
        own = {w: np.array(self.one_word(words[w]), np.int32) for w in odd.tolist()}
        split = np.concatenate([[0], np.cumsum(counts)])
        pieces, done = [], 0
        for w, tokens in sorted(own.items()):
            pieces += [flat[split[done] : split[w]], tokens]
            counts[w], done = len(tokens), w + 1
        pieces.append(flat[split[done] :])
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum(counts)])

    def _replay(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token at each position, -1 where one was merged into its left neighbour; words to do again."""
        n = len(data)
        token = np.append(self.single[data], np.int32(-1))  # position n stands for no neighbour
        right = np.arange(1, n + 2, dtype=np.int32)
        left = np.arange(-1, n, dtype=np.int32)
        right[bounds[1:] - 1] = n
        left[bounds[:-1]] = n
        rank = np.full(n + 1, -1, np.int32)  # of the pair that begins at a position
        rank[:n] = self.pair_rank(token[:n], token[right[:n]])
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enter(at: np.ndarray) -> None:
            found = rank[at]
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            for part, r in zip(np.split(at, cuts), found[np.append(0, cuts)].tolist(), strict=True):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(queue, r)

        at = np.flatnonzero(rank[:n] >= 0).astype(np.int32)
        if len(at):
            enter(at)
        odd: list[np.ndarray] = []
        while queue:
            r = heapq.heappop(queue)
            parts = index.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[rank[at] == r]
            if not len(at):
                continue
            joined = right[at[:-1]] == at[1:]
            if joined.any():  # as in "aaa": every other one of a chain merges
                start = np.append(True, ~joined)
                chain = np.flatnonzero(start)
                place = np.arange(len(at)) - np.repeat(chain, np.diff(np.append(chain, len(at))))
                at = at[place % 2 == 0]
            gone = right[at]
            after = right[gone]
            token[at] = r
            token[gone] = -1
            rank[gone] = -1
            right[at] = after
            left[after] = at
            before = left[at]
            before = before[before < n]
            rank[at] = self.pair_rank(token[at], token[right[at]])
            rank[before] = self.pair_rank(token[before], token[right[before]])
            fresh = np.concatenate([at, before])
            made = rank[fresh]
            low = (made >= 0) & (made < r)
            if low.any():
                odd.append(np.searchsorted(bounds, fresh[low], side="right") - 1)
            fresh = np.unique(fresh[made > r])
            if len(fresh):
                enter(fresh)
        return token[:n], np.unique(np.concatenate(odd)) if odd else np.empty(0, np.int64)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens and the number of bytes before each and in all."""
        sizes = self.lengths[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.begins[ids] - ends[:-1], sizes) + np.arange(ends[-1])
        return self.bytes[at], ends


def gather(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of ``flat`` one after another, and the offsets of each."""
    sizes = np.diff(offsets)[which]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.repeat(offsets[which] - ends[:-1], sizes) + np.arange(ends[-1])], ends


def encoder(context: SparkContext, ranks_file: str, kept: list[str], name: str) -> Callable:
    """From batches of ``kept`` and text to batches of ``kept`` and token ids, in each task."""
    # Broadcasts hold plain values: a class would be looked up in its module, which executors need not have.
    shared = context.broadcast(vocabulary_parts(Path(ranks_file).read_bytes()))
    kinds_of = context.broadcast(character_kinds())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*shared.value)
        kinds = np.frombuffer(kinds_of.value, np.uint8)
        numbers: dict[bytes, int] = {}
        held: list[tuple[list[pa.Array], np.ndarray, np.ndarray]] = []
        words = size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            flat, offsets = vocabulary.encode(list(numbers))
            for columns, which, bounds in held:
                ids, ends = gather(flat, offsets, which)
                tokens = pa.ListArray.from_arrays(pa.array(ends[bounds].astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*columns, tokens], names=[*kept, name])
            held.clear()
            numbers.clear()

        for whole in batches:
            for i, j in texts.slices(whole.column("text")):
                batch = whole.slice(i, j - i)
                raw, offsets = texts.flat(batch.column("text"))
                ends = zip(offsets[:-1], offsets[1:], strict=True)
                said = [raw[a:b].tobytes().decode(errors="replace") for a, b in ends]
                distinct, number, bounds = split(said, kinds)
                fresh = len(numbers)
                known = np.array([numbers.setdefault(w, len(numbers)) for w in distinct], np.int32)
                size += sum(map(len, list(numbers)[fresh:]))
                words += len(number)
                held.append(([batch.column(c) for c in kept], known[number], bounds))
                if words >= RUN_WORDS or size >= RUN_BYTES:
                    yield from flush()
                    words = size = 0
        if held:
            yield from flush()

    return run


def decoder(context: SparkContext, ranks_file: str, kept: list[str], name: str) -> Callable:
    """From batches of ``kept`` and token ids to batches of ``kept`` and ``DIGESTS``, in each task."""
    shared = context.broadcast(vocabulary_parts(Path(ranks_file).read_bytes(), merges=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*shared.value)
        for batch in batches:
            lists = batch.column(name)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(counts)])
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            coded, decoded = [], []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                coded.append(hashlib.sha256(ids[a:b].astype("<u4").tobytes()).hexdigest())
                state = hashlib.sha256()
                for i in range(a, b, GATHERED):
                    state.update(vocabulary.decode(ids[i : min(i + GATHERED, b)])[0].tobytes())
                decoded.append(state.hexdigest())
            columns = [*(batch.column(c) for c in kept), pa.array(counts), pa.array(coded), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *DIGESTS])

    return run


def encode(documents: DataFrame, ranks_file: str, name: str = "token_ids") -> DataFrame:
    """Add the token ids of ``text`` as ``name`` (array<int>), replacing such a column, and drop ``text``.

    Each word of the byte-level pattern is encoded on its own and special tokens are ordinary text. A null
    text has no tokens, like an empty one; bytes that are not UTF-8 count as U+FFFD. Rows are kept as they
    are, repeated ones too. ``ranks_file`` is read on the driver.
    """
    kept = [c for c in documents.columns if c not in (name, "text")]
    run = encoder(documents.sparkSession.sparkContext, ranks_file, kept, name)
    added = T.StructField(name, T.ArrayType(T.IntegerType(), False))
    schema = T.StructType([*(documents.schema[c] for c in kept), added])
    return documents.select(*kept, "text").mapInArrow(run, schema)


def _digested(frame: DataFrame, kept: list[str]) -> T.StructType:
    return T.StructType([*(frame.schema[c] for c in kept), *(T.StructField(a, k) for a, k in DIGESTS.items())])


def digests(encoded: DataFrame, ranks_file: str, name: str = "token_ids") -> DataFrame:
    """Replace ``name`` by n_tokens, ids_sha256 and decoded_sha256; the bytes are decoded from the ids."""
    kept = [c for c in encoded.columns if c not in (name, *DIGESTS)]
    run = decoder(encoded.sparkSession.sparkContext, ranks_file, kept, name)
    return encoded.select(*kept, name).mapInArrow(run, _digested(encoded, kept))


def encoded_digests(documents: DataFrame, ranks_file: str, name: str = "token_ids") -> DataFrame:
    """:func:`digests` of :func:`encode` in one pass, by which ids stay in the task."""
    kept = [c for c in documents.columns if c not in (name, "text", *DIGESTS)]
    context = documents.sparkSession.sparkContext
    code, check = (make(context, ranks_file, kept, name) for make in (encoder, decoder))
    return documents.select(*kept, "text").mapInArrow(lambda batches: check(code(batches)), _digested(documents, kept))
