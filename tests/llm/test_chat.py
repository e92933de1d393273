from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from playmart.llm import chat


def message(conv, turn, role, parts):
    return (conv, turn, role, [(t, x, r, n) for t, x, r, n in parts] if parts is not None else None, "own")


SCHEMA = f"conv_id long, turn long, role string, content array<{chat.PART}>, formatted string"


def test_texts_and_roles_come_back(spark):
    rng = random.Random(5)
    bits = ["<", "|", "\\", "/", "s>", "[", "INST]", "\n", "<|end|>\n", "<|turn|>", "é", "$1", "<|text|>\n", "&"]
    rows = [(c, t, rng.choice(["user", "assistant", "<|x", "[INST]"]), "".join(rng.choices(bits, k=rng.randint(0, 12)))) for c in range(80) for t in range(rng.randint(1, 5))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("content", chat.text_parts(F.col("text")))
    out = chat.format_chats(df)
    for o in out.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("t"), chat.learned_text(F.col("formatted"), F.col("spans")).alias("l")).collect():
        want = [(r[2], r[3]) for r in rows if r[0] == o.conv_id]
        assert [(x.role, x.text) for x in o.t] == want
        assert o.l == "".join(t for role, t in want if role == "assistant")
        assert o.formatted.count("<|end|>") == len(want)


def test_parts_become_numbered_placeholders(spark):
    df = spark.createDataFrame([
        message(1, 1, "assistant", [("text", "ok ", None, None), ("document", None, "c.pdf", 1000)]),
        message(1, 0, "user", [("image", None, "a.png", 576), ("text", "and <|image:1|>", None, None), ("audio", None, "b.wav", None), ("video", None, "d", 7)]),
    ], SCHEMA)
    o = chat.format_chats(df).first()
    assert "<|image:1|>and <\\|image:1|><|audio:2|><|document:3|><|end|>" in o.formatted and "ok <|document:4|>" in o.formatted
    assert [(a.number, a.turn, a.type, a.ref, a.tokens) for a in o.attachments] == [
        (1, 0, "image", "a.png", 576), (2, 0, "audio", "b.wav", 0), (3, 0, "video", "d", 7), (4, 1, "document", "c.pdf", 1000)]
    assert o.attached_tokens == 1583
    for s in o.spans:
        assert o.formatted[s.start + s.length :].startswith("<|end|>") and o.formatted[: s.start].endswith("<|text|>\n")


@pytest.mark.parametrize("content", [None, [], [(None, None, None, None)], [("text", "", None, None)]])
def test_messages_without_content_are_empty(spark, content):
    df = spark.createDataFrame([message(None, None, None, content)] * 2, SCHEMA)
    o = chat.format_chats(df).first()
    assert o.conv_id is None and o.formatted == "<|turn|><|text|>\n<|end|>\n" * 2 and o.attached_tokens == 0


def test_ties_are_ordered_and_long_texts_kept(spark):
    rows = [message(1, 0, "user", [("text", x, None, None)]) for x in ("b", "a", "b", "y" * 100_000)]
    o = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).select(chat.read_back(F.col("formatted")).alias("t")).first()
    assert [x.text for x in o.t] == ["a", "b", "b", "y" * 100_000]
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([message(1, 0, "user", [])], SCHEMA)
    plan = chat.format_chats(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
