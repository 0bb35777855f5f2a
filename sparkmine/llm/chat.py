"""Conversations as training text with a loss mask.

The template writes a turn as ``<role>``, a line end, the text, ``</turn>`` and a line end, with a backslash
before every backslash and angle bracket of roles and texts. So a bare ``<`` always begins a marker, and
removing the backslashes gives the text back. The text is encoded once with offsets; sorted turn spans
are cut with token spans by binary search, which gives the mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template.
END = "</turn>\n"
CONTROL = re.compile(r"[\\<>]")
INNER = r"[^\\<>]*(?:\\.[^\\<>]*)*"
TURN = re.compile(rf"<({INNER})>\n({INNER}){re.escape(END)}", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)

SEGMENT_CHARS = 1 << 18  # a conversation is encoded in runs of whole turns of about this length
TIE_CHARS = 32  # of the text, by which rows of one turn and role are told apart when ranges are cut
SCHEMA = (
    "conv_id long, segment long, text string, token_ids array<int>, token_starts array<int>, "
    "token_ends array<int>, token_loss array<boolean>, loss_starts array<int>, loss_ends array<int>"
)
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_tokens long, n_loss_tokens long"
)


def escaped(text: str) -> str:
    return CONTROL.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def masked(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which tokens meet one of the sorted disjoint ``spans``, and the characters in which they do.

    The characters come as disjoint ranges. Tokens that share a character are merged there.
    """
    first = np.searchsorted(spans[:, 1], starts, side="right")
    last = np.searchsorted(spans[:, 0], ends, side="left")
    loss = last > first
    met = np.flatnonzero(loss)
    counts = (last - first)[met]
    token = np.repeat(met, counts)
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[token]
    begin = np.maximum(starts[token], spans[turn, 0])
    end = np.minimum(ends[token], spans[turn, 1])
    if len(begin):
        reached = np.maximum.accumulate(end)
        fresh = np.ones(len(begin), bool)
        fresh[1:] = begin[1:] > reached[:-1]
        at = np.flatnonzero(fresh)
        begin, end = begin[at], np.maximum.reduceat(end, at)
    return loss, begin, end


def format_conversations(
    conversations: DataFrame, tokenizer_file: str, learn: str = "assistant", segment_chars: int = SEGMENT_CHARS
) -> DataFrame:
    """Text, tokens and loss mask of ``conversations(conv_id, turn, role, text)``.

    One row per segment: a run of whole turns of one conversation, nearly always all of it. ``segment`` rises in
    the order of a conversation, not by ones. A segment begins with a marker after a line end, where the tokenizer
    always begins a token, so encoding segments gives the tokens of the whole. Rows come by ranges of
    conversation and turn, so a long conversation is the work of several tasks. Rows of a conversation come sorted, by turn and then role and text;
    null roles and texts count as empty, a null conv_id is a conversation too, and repeated rows are turns
    of their own. ``token_loss`` marks tokens that meet a text of ``learn``; ``loss_starts`` and
    ``loss_ends`` are the characters of those texts under them. Rows are streamed through a task, so memory follows the
    segment, not the conversation. ``tokenizer_file`` is read on the driver.
    """
    source = conversations.sparkSession.sparkContext.broadcast(Path(tokenizer_file).read_text(encoding="utf-8"))

    def format_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from tokenizers import Tokenizer, processors

        first = TaskContext.get().partitionId() << 32  # ranges rise with the number of the partition
        tokenizer = Tokenizer.from_str(source.value)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        parts: list[str] = []
        spans: list[tuple[int, int]] = []
        length, number, current = 0, first, None
        done: list[list] = [[] for _ in range(9)]

        def close() -> None:
            whole = "".join(parts)
            coded = tokenizer.encode(whole, add_special_tokens=False)
            offsets = np.array(coded.offsets, dtype=np.int32).reshape(-1, 2)
            learned = np.array(spans, dtype=np.int32).reshape(-1, 2)
            loss, begin, end = masked(offsets[:, 0], offsets[:, 1], learned)
            row = [current[0], number, whole, coded.ids, offsets[:, 0], offsets[:, 1], loss, begin, end]
            for column, value in zip(done, row, strict=True):
                column.append(value)

        kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int32())] * 3]
        kinds += [pa.list_(pa.bool_()), *[pa.list_(pa.int32())] * 2]
        names = [part.strip().split()[0] for part in SCHEMA.split(", ")]

        def batch() -> pa.RecordBatch:
            made = [pa.array(c, type=k) for c, k in zip(done, kinds, strict=True)]
            for column in done:
                column.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        size = 0
        for rows in batches:
            ids, roles, texts = (rows.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for conv, role, text in zip(ids, roles, texts, strict=True):
                changed = current is None or current[0] != conv
                if parts and (changed or length >= segment_chars):
                    close()
                    size += length
                    parts, spans, length = [], [], 0
                    number += 1
                    if size >= segment_chars:
                        yield batch()
                        size = 0
                if changed:
                    current, number = (conv,), first
                head = f"<{escaped(role or '')}>\n"
                body = escaped(text or "")
                if role == learn and body:
                    spans.append((length + len(head), length + len(head) + len(body)))
                parts += [head, body, END]
                length += len(head) + len(body) + len(END)
        if parts:
            close()
        if done[0]:
            yield batch()

    order = ["conv_id", "turn", "role", "text"]
    return (
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
        .repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, TIE_CHARS))
        .sortWithinPartitions(*order)
        .mapInArrow(format_rows, SCHEMA)
    )


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the text and mask of ``format_conversations``, in any order.

    Turns are parsed from the text; the learned text is what lies under the mask. The segments of a conversation are
    streamed through one task, since a hash of it is sequential; its tokens stay where they were made.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in DIGEST_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3]
        current, state, out = None, None, []

        def close() -> None:
            conv, turns, said, chars, learned, whole, tokens, lossy = state
            out.append((conv, turns, said.hexdigest(), chars, learned.hexdigest(), whole, tokens, lossy))

        def batch() -> pa.RecordBatch:
            made = [pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        for rows in batches:
            columns = ("conv_id", "text", "loss_starts", "loss_ends", "tokens", "lossy")
            for conv, text, begins, ends, tokens, lossy in zip(*(rows.column(c) for c in columns), strict=True):
                conv, text = conv.as_py(), text.as_py()
                if current is None or current[0] != conv:
                    if state:
                        close()
                    current, state = (conv,), [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                at = 0
                for turn in TURN.finditer(text):
                    if turn.start() != at:
                        raise ValueError("a segment is not a sequence of turns")
                    at = turn.end()
                    state[1] += 1
                    state[2].update(f"{unescaped(turn[1])}\n{unescaped(turn[2])}\n".encode())
                if at != len(text):
                    raise ValueError("a segment is not a sequence of turns")
                learned = unescaped(
                    "".join(text[a:b] for a, b in zip(begins.values.to_pylist(), ends.values.to_pylist(), strict=True))
                )
                state[3] += len(learned)
                state[4].update(learned.encode())
                state[5] += len(text)
                state[6] += tokens.as_py()
                state[7] += lossy.as_py()
            if len(out) >= 1_000:
                yield batch()
        if state:
            close()
        if out:
            yield batch()

    counted = formatted.select(
        "conv_id",
        "segment",
        "text",
        "loss_starts",
        "loss_ends",
        F.size("token_loss").alias("tokens"),
        F.size(F.filter("token_loss", lambda learned: learned)).alias("lossy"),
    )
    ordered = counted.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return ordered.mapInArrow(digest, DIGEST_SCHEMA)
