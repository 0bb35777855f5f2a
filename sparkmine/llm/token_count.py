"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every piece that occurs in the distinct words of a run of texts. A dynamic
program over all these words at once carries, for each position, the best score and how many tokens it took;
pieces themselves are never written down. Rules are those of the Unigram model of the tokenizers library:
of equally good ways to a position the one whose last piece begins first wins; a character that is no piece
costs ten below the worst piece and counts as its UTF-8 bytes if the vocabulary has byte pieces.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sparkmine.llm import texts
from sparkmine.llm.bpe import distinct_words

BLANK = "▁"  # stands for a blank in the pieces
UNKNOWN_PENALTY = 10.0
TOGETHER = 200_000  # characters of distinct words solved at once
RUN_CHARS = 4_000_000  # characters of distinct words held


def read_pieces(model_file: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with their scores as a sentencepiece file has them, and the number of the unknown piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    count = model.get_piece_size()
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(count)], model.unk_id()


class Unigram:
    """A vocabulary of scored pieces, ready to count."""

    def __init__(self, pieces: Sequence[tuple[str, float]], unknown: int, byte_fallback: bool = True):
        import ahocorasick

        self.pieces, self.unknown = list(pieces), unknown
        self.scores = {p: s for p, s in self.pieces}
        self.bytes = byte_fallback and all(f"<0x{i:02X}>" in self.scores for i in range(256))
        self.worst = min(s for _, s in self.pieces) - UNKNOWN_PENALTY
        self.characters = np.array(sorted(ord(p) for p in self.scores if len(p) == 1), np.uint32)
        known = {chr(c) for c in self.characters.tolist()}
        if any(BLANK in p.lstrip(BLANK) for p in self.scores):
            raise ValueError("a piece that goes on after a blank would join words")
        # A run of unknown characters counts as one token if it is itself a piece, as the unknown piece is.
        self.odd = {self.pieces[unknown][0]} | {p for p in self.scores if len(p) > 1 and not known & set(p)}
        self.automaton = ahocorasick.Automaton()
        self.found_scores = np.array(list(self.scores.values()))
        self.found_sizes = np.array([len(p) for p in self.scores], np.int64)
        for i, piece in enumerate(self.scores):
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()

    def one_word(self, word: str) -> tuple[float, int]:
        """Best score and tokens of one word, piece by piece."""
        best: list[tuple[float, int, bool] | None] = [(0.0, 0, False)] + [None] * len(word)
        longest = int(self.found_sizes.max())
        for i, c in enumerate(word):
            for j in range(i + 1, min(i + longest, len(word)) + 1):
                score = self.scores.get(word[i:j])
                if score is None and (j > i + 1 or c in self.scores):
                    continue
                total = best[i][0] + (self.worst if score is None else score)
                if best[j] is None or total > best[j][0]:
                    unknown = score is None or word[i:j] == self.pieces[self.unknown][0]
                    best[j] = (total, i, unknown)
        tokens, run_end, j = 0, None, len(word)
        while j > 0:
            _, i, unknown = best[j]
            if unknown and run_end is None:
                run_end = j
            if run_end is not None and (not unknown or i == 0):
                run = word[(i if unknown else j) : run_end]
                tokens += 1 if run in self.scores or not self.bytes else len(run.encode())
                run_end = None
            tokens += not unknown
            j = i
        return best[-1][0], tokens

    def unknown_run(self, word: str) -> bool:
        """Whether two characters in a row are no pieces."""
        lone = [c not in self.scores for c in word]
        return any(a and b for a, b in zip(lone, lone[1:], strict=False))

    def count(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best score and number of tokens of each word."""
        scores, tokens = np.zeros(len(words)), np.zeros(len(words), np.int64)
        ends = np.cumsum([len(w) for w in words]) if words else np.empty(0, np.int64)
        i = 0
        while i < len(words):
            base = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, base + TOGETHER, side="right")))
            scores[i:j], tokens[i:j] = self._solve(words[i:j])
            i = j
        for i, word in enumerate(words):
            if any(o in word for o in self.odd) or not self.bytes and self.unknown_run(word):
                scores[i], tokens[i] = self.one_word(word)
        return scores, tokens

    def _solve(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        # a separator that no piece has keeps pieces within their words; each word has a place for its begin
        joined = "".join(f"\x00{w}" for w in words)
        sizes = np.array([len(w) for w in words], np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        found = np.fromiter(self.automaton.iter(joined), dtype=[("end", np.int64), ("piece", np.int64)])
        end, piece = found["end"], found["piece"]
        start = end - self.found_sizes[piece]
        inside = np.ones(len(codes), bool)
        inside[begins] = False
        crossing = np.concatenate([[0], np.cumsum(~inside)])
        whole = crossing[end + 1] == crossing[start + 1]
        end, start, piece = end[whole], start[whole], piece[whole]
        spot = np.minimum(np.searchsorted(self.characters, codes), len(self.characters) - 1)
        lone = np.flatnonzero(inside & (self.characters[spot] != codes))
        code = codes[lone]
        width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        if not self.bytes:
            width[:] = 1
        # matches come by end and then by start; an unknown character begins after all that end with it
        at = np.searchsorted(end, lone, side="right")
        gain = np.insert(self.found_scores[piece], at, self.worst)
        cost = np.insert(np.ones(len(piece), np.int64), at, width)
        end, start = np.insert(end, at, lone), np.insert(start, at, lone - 1)
        offset = end - np.repeat(begins, sizes + 1)[end]
        if len(words) and sizes.max() < 1 << 15:
            offset = offset.astype(np.int16)  # sorts faster
        order = np.argsort(offset, kind="stable")
        end, start, gain, cost, offset = end[order], start[order], gain[order], cost[order], offset[order]
        best, tokens = np.zeros(len(codes)), np.zeros(len(codes), np.int64)
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(offset) > 0)), len(offset))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            total = best[start[a:b]] + gain[a:b]
            head = np.flatnonzero(np.append(True, np.diff(end[a:b]) > 0))
            most = np.maximum.reduceat(total, head)
            wins = total == np.repeat(most, np.diff(np.append(head, b - a)))
            first = np.minimum.reduceat(np.where(wins, np.arange(b - a), b - a), head)
            to = end[a:b][head]
            best[to] = most
            tokens[to] = tokens[start[a:b][first]] + cost[a:b][first]
        return best[begins + sizes], tokens[begins + sizes]


def blank_starts(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where words start: at a text's begin and at a blank, or what stands for one, after anything else."""
    start = np.zeros(len(codes), bool)
    if len(codes):
        blank = (codes == 0x20) | (codes == ord(BLANK))
        start[1:] = blank[1:] & ~blank[:-1]
        start[begins] = True
    return np.flatnonzero(start)


def count_tokens(documents: DataFrame, model_file: str, byte_fallback: bool = True) -> DataFrame:
    """Replace ``text`` by n_tokens and score, those of the best segmentation of the whole text.

    A blank is put before each text that is not empty, and blanks become ``BLANK``, as the tokenizer does.
    Null and empty texts have no tokens and score 0; bytes that are not UTF-8 count as U+FFFD. No piece goes on
    after a blank, so words are counted on their own, each distinct one once per run of texts; with scores
    that add without rounding, as whole numbers do, the sum is exactly that of the whole text. Rows are kept,
    repeated ones too. ``model_file`` is read on the driver.
    """
    pieces = documents.sparkSession.sparkContext.broadcast(read_pieces(model_file))
    added = ["n_tokens", "score"]
    kept = [c for c in documents.columns if c not in ("text", *added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram(*pieces.value, byte_fallback)
        numbers: dict[str, int] = {}
        held: list[tuple[list[pa.Array], np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            scores, tokens = model.count(list(numbers))
            for columns, which, bounds in held:
                found = [np.concatenate([[0], np.cumsum(x[which])]) for x in (tokens, scores)]
                sums = [pa.array(np.diff(x[bounds])) for x in found]
                yield pa.RecordBatch.from_arrays([*columns, *sums], names=[*kept, *added])
            held.clear()
            numbers.clear()

        for whole in batches:
            for i, j in texts.slices(whole.column("text")):
                batch = whole.slice(i, j - i)
                raw, offsets = texts.flat(batch.column("text"))
                ends = zip(offsets[:-1], offsets[1:], strict=True)
                said = [raw[a:b].tobytes().decode(errors="replace") for a, b in ends]
                said = [f" {x}" if x else x for x in said]
                lengths = np.array([len(x) for x in said], np.int64)
                joined = "".join(said)
                codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
                raw = np.frombuffer(joined.encode(), np.uint8)
                begins = np.cumsum(lengths) - lengths
                starts = blank_starts(codes, begins[lengths > 0])
                bounds = np.searchsorted(starts, np.append(begins, len(codes)))
                which = np.empty(0, np.int64)
                if len(starts):
                    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
                    at = (np.cumsum(width) - width)[starts]
                    first, number = distinct_words(raw, at)
                    ends = np.append(at[1:], len(raw))
                    fresh = len(numbers)
                    words = [raw[a:b].tobytes().decode().replace(" ", BLANK) for a, b in zip(at[first], ends[first], strict=True)]
                    which = np.array([numbers.setdefault(w, len(numbers)) for w in words])[number]
                    size += sum(map(len, list(numbers)[fresh:]))
                held.append(([batch.column(c) for c in kept], which, bounds))
                if size >= RUN_CHARS:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*(documents.schema[c] for c in kept), *fields])
    return documents.select(*kept, "text").mapInArrow(run, schema)
