"""Cheapest edits that turn a conversation into turns of user and assistant, by tables of blocks (Four Russians).

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Four states follow them: nothing yet, after s,
after u, after a. Behind each row, the costs of the cheapest end from each state make a vector. Costs differ by a few
units at most, so once the least is taken off there are few vectors; what each block of ``LENGTH`` rows does to each
vector is computed once. A conversation is then read from its end, one lookup per block, and only vectors between blocks
are kept. The edits are traced from the beginning: a block is expanded backward from the vector behind it, which gives
the vectors inside, and the least letter whose cost fits is taken, so ties need no further search.

A row is one byte for this. Rows are put in order by a range sort, in which a long conversation is spread over
many tasks, and each task sends on the bytes. Texts are shuffled once.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.tables import Scratch

# Costs, and the white space of a blank text.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
FINISHED = (".", "!", "?")

LENGTH = 4  # rows in a block
SEGMENT = 1 << 16  # rows whose bytes are sent on together
BATCH_CHARS = 1 << 20
EXPANDED = 1 << 14  # traced blocks that a task remembers

# States, and classes of roles by their initial.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
CLASSES = "sua"
OTHER = 3
OK, BLANK, REPEATED, CUT = range(4)  # first fault of a row
GONE = 8  # symbol of a row that must go
SYMBOLS = 9
REACHED = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
NEEDED = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
BEHIND = {state: AFTER_A if role == "assistant" else AFTER_U for state, role in NEEDED.items()}
END = (0, 2 * INSERT, INSERT, 0)
SYMBOL_OF = bytes(GONE if code % 4 in (BLANK, REPEATED) else code // 4 * 2 + (code % 4 == CUT) for code in range(16))


def before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from each state before a row, from those after it."""
    role, extra = divmod(symbol, 2)
    costs = []
    for state in range(4):
        best = DELETE + after[state]
        if symbol != GONE:
            best = min(best, REROLE + extra * TRUNCATED + after[BEHIND[state]])
            if (state, role) in REACHED:
                best = min(best, extra * TRUNCATED + after[REACHED[state, role]])
        costs.append(best)
    after_u = min(costs[AFTER_U], INSERT + costs[AFTER_A])
    costs[AFTER_A] = min(costs[AFTER_A], INSERT + costs[AFTER_U])
    costs[AFTER_U] = after_u
    costs[START] = min(costs[START], INSERT + after_u)
    costs[AFTER_S] = min(costs[AFTER_S], INSERT + after_u)
    return tuple(costs)


class Tables:
    """All vectors, and what a row and a block of ``length`` rows make of each."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.vectors = [END]
        number = {END: 0}
        follow, cost = [], []
        for vector in self.vectors:  # grows meanwhile
            for symbol in range(SYMBOLS):
                made = before(symbol, vector)
                least = min(made)
                made = tuple(x - least for x in made)
                if made not in number:
                    number[made] = len(self.vectors)
                    self.vectors.append(made)
                follow.append(number[made])
                cost.append(least)
        follow = np.array(follow, np.int32).reshape(-1, SYMBOLS)
        cost = np.array(cost, np.int32).reshape(-1, SYMBOLS)
        self.row_follow, self.row_cost = follow.tolist(), cost.tolist()
        block_follow, block_cost = follow, cost
        for _ in range(length - 1):  # one more row before the block
            block_cost = np.repeat(block_cost[:, None, :], SYMBOLS, 1) + cost[block_follow].transpose(0, 2, 1)
            block_follow = follow[block_follow].transpose(0, 2, 1)
            block_follow, block_cost = (x.reshape(len(follow), -1) for x in (block_follow, block_cost))
        self.block_follow, self.block_cost = block_follow.tolist(), block_cost.tolist()
        self.weights = SYMBOLS ** np.arange(length - 1, -1, -1)
        self.expand = functools.lru_cache(EXPANDED)(self._expand)

    def _expand(self, vector: int, symbols: bytes, state: int) -> tuple[str, int]:
        """Letters of the edits of some rows from ``state`` on, and the state behind them."""
        costs = [self.vectors[vector]]
        for symbol in reversed(symbols):
            costs.append(before(symbol, costs[-1]))
        costs.reverse()
        letters = []
        for i, symbol in enumerate(symbols):
            role, extra = divmod(symbol, 2)
            while True:
                here, after = costs[i][state], costs[i + 1]
                if here == DELETE + after[state]:
                    letters.append("D")
                elif here == INSERT + costs[i][BEHIND[state]]:
                    letters.append("I")
                    state = BEHIND[state]
                    continue
                elif (state, role) in REACHED and here == extra * TRUNCATED + after[REACHED[state, role]]:
                    letters.append("K")
                    state = REACHED[state, role]
                else:
                    letters.append("R")
                    state = BEHIND[state]
                break
        return "".join(letters), state

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """Least cost, and the ASCII-least letters of edits of that cost."""
        lone = len(symbols) % self.length  # rows before the first whole block
        codes = np.frombuffer(symbols, np.uint8)[lone:].reshape(-1, self.length) @ self.weights
        vector, cost = 0, 0
        behind = np.empty(len(codes), np.int32)
        for i in range(len(codes) - 1, -1, -1):
            behind[i] = vector
            code = codes[i]
            cost += self.block_cost[vector][code]
            vector = self.block_follow[vector][code]
        first = vector
        for symbol in reversed(symbols[:lone]):
            cost += self.row_cost[vector][symbol]
            vector = self.row_follow[vector][symbol]
        cost += self.vectors[vector][START]
        letters, state = self.expand(first, symbols[:lone], START)
        parts = [letters]
        for i, at in enumerate(range(lone, len(symbols), self.length)):
            letters, state = self.expand(int(behind[i]), symbols[at : at + self.length], state)
            parts.append(letters)
        return cost, "".join(parts) + "I" * (END[state] // INSERT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text, copies`` with planted faults, by crc32 of ``conv_id:turn``; nulls as one space.

    ``copies`` is how often a row stands there: 0 if it is dropped, 2 if it is repeated.
    """
    blank = F.lit(" ")
    part = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def row_fault(text: Column) -> Column:
    """Fault of a text by itself."""
    ended = F.rtrim(text, F.lit(SPACES))
    return F.when(ended == "", BLANK).when(~F.right(ended, F.lit(1)).isin(*FINISHED), CUT).otherwise(OK)


def symbols(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, segment, codes, first_turn, last_turn, turns`` of ``rows(conv_id, turn, role, mark, fault, copies)``.

    ``codes`` has a byte per row in order: its class of role and its first fault. ``mark`` names role and text.
    """
    keys = ["conv_id", "turn", "role", "mark"]
    alike = scratch.write("alike", rows.groupBy(*keys).agg(F.min("fault").alias("fault"), F.sum("copies").alias("copies")))
    first = F.min(F.struct(F.isnotnull("turn").alias("known"), F.col("turn").alias("turn"))).alias("first")
    seen = alike.filter("copies > 0").groupBy("conv_id", "mark").agg(first, F.count(F.lit(1)).alias("turns"))
    seen = seen.filter("turns > 1").select(F.col("conv_id").alias("conv"), F.col("mark").alias("same"), "first")
    met = alike.join(seen, alike["conv_id"].eqNullSafe(F.col("conv")) & (F.col("mark") == F.col("same")), "left")
    again = F.isnotnull("first") & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    letter = F.substring("role", 1, 1)
    role = F.coalesce(*[F.when(letter == c, i) for i, c in enumerate(CLASSES)], F.lit(OTHER))
    fault = F.when((F.col("fault") != BLANK) & again, REPEATED).otherwise(F.col("fault"))
    coded = met.select(*keys, "copies", (role * 4 + fault).cast("int").alias("code"))
    ordered = coded.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "turn", "copies", "code")
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    schema = "conv_id long, segment long, codes binary, first_turn long, last_turn long, turns long"
    names = [part.split()[0] for part in schema.split(", ")]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        current, codes, first, last, turns = None, bytearray(), None, None, 0
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            made = [pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        size = 0
        for rows in batches:
            columns = (rows.column(c).to_pylist() for c in ("conv_id", "turn", "copies", "code"))
            for conv, turn, copies, code in zip(*columns, strict=True):
                if current is not None and (current[0] != conv or len(codes) >= SEGMENT):
                    out.append((current[0], number, bytes(codes), first, last, turns))
                    size += len(codes)
                    codes, first, last, turns = bytearray(), None, None, 0
                    number += 1
                    if size >= SEGMENT or len(out) >= 1_000:
                        yield batch()
                        size = 0
                current = (conv,)
                if not copies:
                    continue
                codes.append(code)
                codes += bytes([code if code % 4 == BLANK else code - code % 4 + REPEATED]) * (copies - 1)
                if turn is not None and turn != last:
                    first = turn if first is None else first
                    last, turns = turn, turns + 1
        if current is not None:
            out.append((current[0], number, bytes(codes), first, last, turns))
            yield batch()

    return ordered.mapInArrow(gather, schema)


EDITS = (
    "conv_id long, place long, edit string, role string, text string, "
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of each conversation of ``rows(conv_id, turn, role, text, copies)``, none of the last four null.

    Each conversation has a head row, place 0, with what was found, the cost and the letters of the edits; then, in order, one
    row per edit: K keeps a row, R gives it another role, D deletes it, I inserts an empty one. Without the
    deleted ones they are the repaired conversation. Rows of a conversation are taken by turn, nulls first, rows of one turn
    by role and a digest of the text, equal ones side by side. A null conv_id is a conversation, too. Rows with 0
    copies only keep their conversation, which then has a head of zeros. The bytes of a conversation, one per row, are in
    one task's memory, as the letters of its edits are in one value; its texts are streamed.
    """
    scratch = Scratch(rows.sparkSession)
    mark = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    marked = rows.select("conv_id", "turn", "role", mark.alias("mark"), "text", "copies")
    coded = symbols(marked.select("conv_id", "turn", "role", "mark", row_fault(F.col("text")).alias("fault"), "copies"), scratch)

    def none(kind: str) -> Column:
        return F.lit(None).cast(kind)

    own = ["conv_id", "segment", "codes", "first_turn", "last_turn", "turns"]
    order = ["conv_id", "lead", "segment", "turn", "role", "mark"]
    heads = coded.select(F.lit(0).alias("lead"), *own)
    heads = heads.withColumns({c: none(k) for c, k in {"turn": "long", "role": "string", "mark": "binary"}.items()})
    heads = heads.withColumns({"text": none("string"), "copies": none("long")})
    kinds = dict(zip(own[1:], ["long", "binary", "long", "long", "long"], strict=True))
    said = marked.filter("copies > 0").withColumn("lead", F.lit(1)).withColumns({c: none(k) for c, k in kinds.items()})
    dealt = heads.unionByName(said).repartition("conv_id").sortWithinPartitions(*order)
    names = [part.split()[0] for part in EDITS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * 6, pa.string()]

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tables()
        parts: list[bytes] = []
        out: list[tuple] = []
        current, first, last, turns, size = None, None, None, 0, 0
        codes, audit, at, row, state = b"", None, 0, 0, START

        def batch() -> pa.RecordBatch:
            made = [pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        def begin() -> None:
            """Judge the rows whose bytes have come."""
            nonlocal codes, audit, at, row, state
            codes, at, row, state = b"".join(parts), 0, 0, START
            parts.clear()
            cost, audit = known.repair(codes.translate(SYMBOL_OF + bytes(240)))
            code = np.frombuffer(codes, np.uint8)
            faults = np.bincount(code % 4, minlength=4)
            role = code // 4
            pair = role[:-1] * 4 + role[1:]
            illegal = np.count_nonzero(~np.isin(pair, [1, 4 + 2, 8 + 1]))
            gaps = last - first + 1 - turns if first is not None else 0
            found = (gaps, *(int(faults[i]) for i in (BLANK, REPEATED, CUT)), illegal, cost, audit)
            out.append((current[0], 0, None, None, None, *found))

        def inserts() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                at += 1
                out.append((current[0], at, "I", NEEDED[state], "", *[None] * 7))
                state = BEHIND[state]

        def end() -> None:
            if audit is None:
                begin()
            inserts()
            if at != len(audit) or row != len(codes):
                raise ValueError("edits and rows do not fit")

        for rows in batches:
            columns = ["conv_id", "lead", "codes", "first_turn", "last_turn", "turns", "role", "text", "copies"]
            for conv, lead, some, low, high, count, role, text, copies in zip(
                *(rows.column(c).to_pylist() for c in columns), strict=True
            ):
                if current is None or current[0] != conv:
                    if current is not None:
                        end()
                    current, audit, first, last, turns = (conv,), None, None, None, 0
                if not lead:
                    parts.append(some)
                    if low is not None:
                        turns += count - (last is not None and last == low)
                        first, last = (low if first is None else first), high
                    continue
                if audit is None:
                    begin()
                for _ in range(copies):
                    inserts()
                    letter, class_of = audit[at], codes[row] // 4
                    at, row = at + 1, row + 1
                    if letter == "R":
                        out.append((conv, at, letter, NEEDED[state], text, *[None] * 7))
                        state = BEHIND[state]
                    else:
                        out.append((conv, at, letter, role, text, *[None] * 7))
                        state = REACHED[state, class_of] if letter == "K" else state
                    size += len(text)
                if size >= BATCH_CHARS or len(out) >= 10_000:
                    yield batch()
                    size = 0
        if current is not None:
            end()
            yield batch()

    return dealt.mapInArrow(edit, EDITS)


def digests(edits: DataFrame) -> DataFrame:
    """One row per conversation: its head and ``repaired_sha256`` of the ``role:text`` of what is left, joined by line ends.

    The frame must come straight from :func:`repair`, whose rows of a conversation follow one another in a partition.
    """
    heads = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    schema = "conv_id long, " + ", ".join(f"{c} long" for c in heads[:-1]) + ", audit string, repaired_sha256 string"
    names = [part.split()[0] for part in schema.split(", ")]
    types = [*[pa.int64()] * 7, pa.string(), pa.string()]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state, fresh = None, None, True
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            made = [pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("conv_id", "place", "edit", "role", "text", *heads)]
            for conv, place, letter, role, text, *found in zip(*columns, strict=True):
                if not place:
                    if head is not None:
                        out.append((*head, state.hexdigest()))
                    head, state, fresh = (conv, *found), hashlib.sha256(), True
                elif letter != "D":
                    state.update(f"{'' if fresh else chr(10)}{role}:{text}".encode())
                    fresh = False
            if len(out) >= 1_000:
                yield batch()
        if head is not None:
            out.append((*head, state.hexdigest()))
            yield batch()

    return edits.mapInArrow(digest, schema)
