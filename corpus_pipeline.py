"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept and returns a frame
that is written as Parquet and read again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playmart.llm import decontam, langid, near_copies, pii, retrieval_packing
from playmart.llm.common import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (SimHash fingerprints within three bits, or five-word shingles with a similarity
    of 0.8 or more) the smallest id stays."""
    return near_copies.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, give or take a fifth of its words, go."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts become placeholders."""
    return pii.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 1024."""
    return retrieval_packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", mask_personal_data),
    ("packing", pack),
]

# Models, spans and tokens are beyond SQL; tests hold the stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result between two stages is kept in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"), "zstd").rows
    return STAGES[-1][1](spark, docs, sf_dir)
