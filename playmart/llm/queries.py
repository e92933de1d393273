"""The operators as registered queries over the given tables, and the SQL of those that have some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm import (
    attention_lm, bfd_packing, chat, decontam, langid, order_minhash, ordinal_quality, pii, prefix_trie, retrieval_packing, simhash, spelling, urls,
)
from playmart.llm.oracles import PREFIX_TRIE, SPELLING

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op7_chat_format": r"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
            union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), told as (
            select conv_id, turn, role, text,
                   regexp_replace(role, '(<)(\\*(?:\||/?s>))|(\[)(\\*/?INST\])', '\1\3\\\2\4', 'g') as shown_role,
                   regexp_replace(text, '(<)(\\*(?:\||/?s>))|(\[)(\\*/?INST\])', '\1\3\\\2\4', 'g') as shown
            from turns
        )
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
               cast(sum(length('<|turn|>' || shown_role || '<|text|>' || chr(10) || shown || '<|end|>' || chr(10))) as bigint) as formatted_chars
        from told group by conv_id""",
    "op11_spelling_variants": SPELLING,
    "op13_prefix_trie": PREFIX_TRIE,
}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)


@_query
def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_pages(_read(spark, sf_dir, "pages"), URL_RULES)


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per leak: a document, the item it holds, the word edits between them."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return (
        decontam.find_leaks(docs, _read(spark, sf_dir, "benchmark"))
        .select("row.doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
    )


@_query
def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grade 0: toxic, 1: neither toxic nor good, 2: good and not toxic."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("toxic") == 0, 1 + F.col("quality"))
    model = ordinal_quality.fit(docs, _read(spark, sf_dir, "labels"), grade, 3)
    return ordinal_quality.rate(docs, model, carry=["doc_id"]).select(
        "row.doc_id", "expected_grade", F.col("tails")[0].alias("p_grade_1"), F.col("tails")[1].alias("p_grade_2"), "grade", "keep")


@_query
def op4_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = retrieval_packing.pack(_read(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@_query
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(_read(spark, sf_dir, "documents"))


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "row.doc_id", "lang_pred", "score", "accepted").withColumn("held_out", held_out)


@_query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.sql("""
        select cast(-7 as bigint) conv_id, cast(turn as bigint) turn, role, '</s>[INST] ok [/INST]' text
        from values (0, 'user'), (1, 'assistant') as t(turn, role)""")
    chats = chat.format_chats(given.union(control).withColumn("content", chat.text_parts(F.col("text"))))
    turns, learned = chat.read_back(F.col("formatted")), chat.learned_text(F.col("formatted"), F.col("spans"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.withColumn("turns", turns).withColumn("learned", learned).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


@_query
def op8_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


@_query
def op9_bfd_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bfd_packing.pack(_read(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op10_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_read(spark, sf_dir, "documents"))

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(counted, pii.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.word_counts(_read(spark, sf_dir, "documents"), alter=spelling.drop_one))


@_query
def op12_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))
    return attention_lm.score(docs, ~held_out).withColumn("held_out", held_out)


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build_trie(*prefix_trie.rebuilt_turns(_read(spark, sf_dir, "conversations")))
