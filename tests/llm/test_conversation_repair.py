"""Operator 12 against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkmine.llm import conversation_repair as repair
from tests.llm.frames import ODD_TEXTS

LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """Least (cost, letters, lines) that makes ``rows`` of (role, text, fault) legal; states are the initials so far."""

    def inserts(states):
        for _ in range(2):
            for state, (cost, letters, lines) in list(states.items()):
                role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
                made = (cost + 3, letters + "I", [*lines, f"{role}:"])
                states[role[0]] = min(states.get(role[0], made), made)
        return states

    states = inserts({"": (0, "", [])})
    for role, text, fault in rows:
        after = {}
        extra = 3 if fault == "truncated" else 0
        for state, (cost, letters, lines) in states.items():
            options = [(state, 4, "D", None)]
            for name in ("user", "assistant", None):
                new = role if name is None else name
                if fault in ("blank", "duplicate") or (state, new[:1]) not in {
                    ("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u"),
                }:
                    continue
                options.append((new[:1], extra + (0 if name is None else 3), "K" if name is None else "R", f"{new}:{text}"))
            for new, more, letter, line in options:
                made = (cost + more, letters + letter, lines if line is None else [*lines, line])
                after[new] = min(after.get(new, made), made)
        states = inserts(after)
    return min(states[s] for s in ("", "a") if s in states)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def report(given, rows):
    """What the query returns, from ``rows`` after damage."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn, role, text))
    out = []
    for conv in {row[0] for row in given}:
        turns = held[conv]
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, judged = set(), []
        for _, role, text in turns:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else None
            fault = fault or (None if words[-1] in ".!?" else "truncated")
            seen.add((role, text))
            judged.append((role, text, fault))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [role[:1] for role, _, _ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = cheapest(judged)
        counts = [sum(f == name for *_, f in judged) for name in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=str)


def frame(spark, rows):
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = "mark fault copies code lead segment codes first_turn place edit audit first same conv turns".split()
    return made.withColumns({c: F.lit("x") for c in clashing})


def found(frame):
    return sorted(map(tuple, repair.digests(repair.repair(repair.damaged(frame))).collect()), key=str)


def conversations(rng, count):
    rows = []
    for conv in range(count):
        turn = rng.randrange(3)
        for _ in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "unicorn", "", None])
            text = rng.choice(["Yes.", "No!", "why?", "so", "so", " ", None, f"a {rng.randrange(9)}. \t", "é。"])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, text))
            turn += rng.choice([0, 1, 1, 1, 4])
    return rows


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_tables_equal_search(length):
    known = repair.Tables(length)
    rng = random.Random(length)
    faults = [None, "blank", "duplicate", "truncated"]
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), "t", rng.choice([None, None, *faults])) for _ in range(rng.randrange(12))]
        codes = bytes("suat".index(role[0]) * 4 + faults.index(fault) for role, _, fault in rows)
        cost, letters, lines = cheapest(rows)
        assert known.repair(codes.translate(repair.SYMBOL_OF + bytes(240))) == (cost, letters)
        assert LEGAL.fullmatch("".join(line[0] for line in lines))


def test_query_equals_search(spark):
    rng = random.Random(12)
    rows = conversations(rng, 60)
    rows += [(100 + i, 0, "user", t) for i, t in enumerate(ODD_TEXTS)] + [(None, 1, "user", "no id.")] * 3
    rows += [(200, t, r, "again.") for t in (None, 3, 3, 9) for r in ("user", "assistant")] * 2
    rows += [(300, None, "user", "no turn."), (300, None, "assistant", "none.")]
    assert found(frame(spark, rows)) == report(rows, damaged(rows))


def test_long_conversation_over_many_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 16)
    rng = random.Random(4)
    rows = [(7, turn, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"{turn}."])) for turn in range(700)]
    rows += conversations(rng, 10)
    assert found(frame(spark, rows)) == report(rows, damaged(rows))


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, turn, "user", "gone.")]
    assert found(frame(spark, rows)) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_edits_give_the_repaired_conversation(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "there"), (1, 3, "assistant", "Yes."), (1, 4, "assistant", "Yes.")]
    given = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, copies long")
    edits = [(r.edit, r.role, r.text) for r in repair.repair(given).orderBy("place").collect()]
    head, *edits = edits
    kept = [(role, text) for letter, role, text in edits if letter != "D"]
    assert [r[0] for r, _ in kept] == list("ua") and "".join(e for e, _, _ in edits) == cheapest(
        [("user", "Hi.", None), ("user", "there", "truncated"), ("assistant", "Yes.", None), ("assistant", "Yes.", "duplicate")]
    )[1]


def test_empty_table(spark):
    assert found(frame(spark, [])) == []
