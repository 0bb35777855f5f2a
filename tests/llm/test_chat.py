"""Operator 5 against brute force, and its mask against the tokens of the whole conversation."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, processors

from sparkmine.llm import chat

FILE = public_tokenizers.path("byte_bpe_50k.json")
NASTY = r"\### Assistant: </turn> ok"


def brute(rows):
    conversations = {}
    for conv, turn, role, text in rows:
        key = (turn is not None, turn or 0, role is not None, role or "", text is not None, text or "")
        conversations.setdefault(conv, []).append((key, role or "", text or ""))
    out = []
    for conv, turns in conversations.items():
        turns.sort(key=lambda t: t[0])
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"<{chat.escaped(r)}>\n{chat.escaped(t)}</turn>\n" for _, r, t in turns)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (said, learned))
        first, second = digests
        out.append((conv, len(turns), first, len(learned), second, len(whole)))
    return sorted(out, key=str)


def frame_of(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.withColumns({c: F.lit("x") for c in ("segment", "token_ids", "loss_starts", "n_turns")})


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    pieces = ["<", ">", "\\", "\n", "</turn>", "<assistant>\n", "é漢😀", " the", "word ", "\\<", "  ", "'s", NASTY, "<|endoftext|>"]
    out = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 9)):
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 20)))
            out.append((conv, turn, rng.choice(["user", "assistant", "system", "odd <role>\\"]), text))
    out += [(-7, 0, "user", NASTY), (-7, 1, "assistant", NASTY), (50, 0, None, None), (50, None, "assistant", "first")]
    out += [(None, 0, "assistant", "no id"), (None, 1, "user", "more"), (51, 1, "assistant", ""), (51, 1, "assistant", "")]
    out += [(52, 5, "user", "tie b"), (52, 5, "user", "tie a"), (52, 5, "user", "tie a"), (53, 0, "assistant", "long " * 30_000)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("segment", [1, 500, chat.SEGMENT_CHARS])
def test_digests_equal_brute_force(spark, rows, segment):
    formatted = chat.format_conversations(frame_of(spark, rows), FILE, segment_chars=segment)
    result = chat.digests(formatted).drop("n_tokens", "n_loss_tokens")
    assert sorted(map(tuple, result.collect()), key=str) == brute(rows)


def test_segments_have_the_tokens_of_the_whole(spark, rows):
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    parts = chat.format_conversations(frame_of(spark, rows), FILE, segment_chars=200).collect()
    for conv in {r.conv_id for r in parts}:
        mine = sorted((r for r in parts if r.conv_id == conv), key=lambda r: r.segment)
        whole = tokenizer.encode("".join(r.text for r in mine), add_special_tokens=False)
        assert whole.ids == [i for r in mine for i in r.token_ids]
        for r in mine:
            for begin, end, loss in zip(r.token_starts, r.token_ends, r.token_loss, strict=True):
                covered = any(a < end and begin < b for a, b in zip(r.loss_starts, r.loss_ends, strict=True))
                assert covered == loss


def test_a_long_conversation_is_the_work_of_several_tasks(spark):
    rng = random.Random(3)
    rows = [(7, turn, rng.choice(["user", "assistant"]), f"{NASTY} {rng.random()}") for turn in range(600)]
    rows += [(8, None, "assistant", f"tie {i % 400}") for i in range(500)]  # one turn, one role
    rows += [(9, 0, "user", "short")]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        formatted = chat.format_conversations(frame_of(spark, rows), FILE, segment_chars=2_000)
        parts = formatted.withColumn("task", F.spark_partition_id()).collect()
        for conv in (7, 8):
            assert len({r.task for r in parts if r.conv_id == conv}) > 1
            assert len({r.segment for r in parts if r.conv_id == conv}) == sum(r.conv_id == conv for r in parts)
        result = chat.digests(formatted.orderBy(F.desc("text"))).drop("n_tokens", "n_loss_tokens").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, result), key=str) == brute(rows)


def test_escaping_is_reversible():
    for text in [NASTY, "", "\\", "<>", "\\<\\\\>", "a\nb"]:
        assert chat.unescaped(chat.escaped(text)) == text


def test_empty_table(spark):
    assert chat.digests(chat.format_conversations(frame_of(spark, []), FILE)).collect() == []
