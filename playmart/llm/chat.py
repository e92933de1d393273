"""Chat formatting with typed content parts, in DataFrame functions alone.

A message's content is an array of parts (type, text, ref, tokens). A visitor turns every part into
text: text parts are escaped, image, audio and document parts become placeholders numbered in order
within their conversation, and each of these records its reference and the tokens it stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,tokens:bigint>"
ATTACHED = ("image", "audio", "document")

# Control strings: `<|` begins the template's own marks; the others belong to templates in common use.
# A text gets one backslash behind the first character of each, however many are there already, so
# that taking one away gives the text back.
_ESCAPE = r"(<(?=\\*(?:\||/?s>))|\[(?=\\*/?INST\]))"
_UNESCAPE = r"(<(?=\\+(?:\||/?s>))|\[(?=\\+/?INST\]))\\"
TURN_END = "<|end|>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1")


def opening(role: Column) -> Column:
    return F.concat(F.lit("<|turn|>"), escaped(role), F.lit("<|text|>\n"))


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _visited(part: Column, number: Column) -> Column:
    """One part as text; `number` is its place among the conversation's attachments."""
    known = F.when(part["type"].isin(*ATTACHED), part["type"]).otherwise(F.lit("document"))
    mark = F.concat(F.lit("<|"), known, F.lit(":"), number.cast("string"), F.lit("|>"))
    return F.when(_is_text(part), escaped(_or_empty(part["text"]))).otherwise(mark)


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def format_chats(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 content: str = "content", learn: str = "assistant") -> DataFrame:
    """One row per conversation.

    formatted: the whole template text. spans: where each message's content lies in it (role, start,
    length in code points, learned), in turn order. attachments: (number, turn, type, ref, tokens) in
    the order of their placeholders. attached_tokens: the tokens they expand to. Messages go by turn,
    then role, then content; null turns come first. Null roles and texts are empty, a part without a
    type is text, a part of an unknown type counts as a document, missing token counts as zero, and a
    message without parts is an empty text. Repeated rows are repeated messages. Messages without a
    conversation id form one conversation. Other columns are not read.
    """
    rows = messages.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).cast("long").alias("turn"), _or_empty(F.col(role)).alias("role"),
                 F.coalesce(F.col(content), F.array().cast(f"array<{PART}>")).alias("parts")).alias("message"),
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("message")).alias("messages"))
    # attachments of the whole conversation in order, and how many come before each message
    flat = F.flatten(F.transform("messages", lambda m: F.transform(
        F.filter(m["parts"], lambda p: ~_is_text(p)), lambda p: F.struct(m["turn"].alias("turn"), p.alias("p")))))
    chats = chats.withColumn("attachments", F.transform(flat, lambda x, i: F.struct(
        (i + 1).alias("number"), x["turn"].alias("turn"), x["p"]["type"].alias("type"), x["p"]["ref"].alias("ref"),
        F.coalesce(x["p"]["tokens"], F.lit(0).cast("long")).alias("tokens"))))
    before = _running(F.transform("messages", lambda m: F.size(F.filter(m["parts"], lambda p: ~_is_text(p)))))
    chats = chats.withColumn("before", before)

    def body(m: Column, i: Column) -> Column:
        parts = m["parts"]
        nth = lambda j: F.col("before")[i] + F.size(F.filter(F.slice(parts, 1, j + 1), lambda p: ~_is_text(p)))
        text = F.array_join(F.transform(parts, lambda p, j: _visited(p, nth(j))), "")
        return F.struct(m["role"].alias("role"), opening(m["role"]).alias("open"), text.alias("body"))

    chats = chats.withColumn("turns", F.transform("messages", body))
    length = F.transform("turns", lambda t: F.char_length(t["open"]) + F.char_length(t["body"]) + len(TURN_END))
    chats = chats.withColumn("starts", _running(length))
    return chats.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["open"], t["body"], F.lit(TURN_END))), "").alias("formatted"),
        F.transform("turns", lambda t, i: F.struct(
            t["role"].alias("role"), (F.col("starts")[i] + F.char_length(t["open"])).alias("start"),
            F.char_length(t["body"]).alias("length"), (t["role"] == learn).alias("learned"))).alias("spans"),
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("attached_tokens"),
    )


def _running(counts: Column) -> Column:
    """For every element the sum of those before it."""
    sums = F.aggregate(
        counts, F.array(F.lit(0)), lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n)))
    return sums


def read_back(formatted: Column) -> Column:
    """array of (role, text) from a formatted conversation; attachments stay placeholders."""
    turns = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda t: t != "")
    return F.transform(turns, lambda t: F.struct(
        unescaped(F.regexp_extract(t, r"(?s)\A<\|turn\|>(.*?)<\|text\|>\n", 1)).alias("role"),
        unescaped(F.regexp_replace(t, r"(?s)\A<\|turn\|>.*?<\|text\|>\n", "")).alias("text")))


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped span by span."""
    return F.array_join(F.transform(
        F.filter(spans, lambda s: s["learned"]), lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def text_parts(text: Column) -> Column:
    """A plain text column as the content of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("long").alias("tokens")))
