"""Token ids of documents, computed once by a byte-level BPE vocabulary and kept as packed integers."""

from __future__ import annotations

import json
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm.common import annotate

# The pre-tokenizer of byte-level BPE vocabularies of this family (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 0  # closes every document


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """Printable stand-in of every byte in the vocabulary file: itself, or the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A vocabulary file's content; small and of fixed size, so every task may hold it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.source = f.read()
        self.size = len(json.loads(self.source)["model"]["vocab"])

    @property
    def kind(self) -> str:
        return "<u2" if self.size <= 1 << 16 else "<u4"

    def encoder(self):
        """text -> list of ids. Special tokens' strings in a text are ordinary text."""
        return _encoder(self.source)


@cache
def _encoder(source: str):
    import tiktoken
    from tokenizers import Tokenizer

    data = json.loads(source)
    special = {x["content"] for x in data.get("added_tokens", ())}
    byte_of = _byte_of()
    ranks = {bytes(byte_of[c] for c in t): i for t, i in data["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_str(source)
    slow.encode_special_tokens = True

    def encode(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except BaseException as failed:  # its regular expressions give up on huge runs of white space
            if type(failed).__name__ != "PanicException":
                raise
            return slow.encode(text, add_special_tokens=False).ids

    return encode


def vocabulary(spark: SparkSession, path: str | None = None):
    """The vocabulary as a broadcast, so that executors need not have the file."""
    return spark.sparkContext.broadcast(Vocabulary(path or default_path()))


def tokenized(docs: DataFrame, words, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (packed little-endian integers, END last) and tokens (their number) of whole texts.

    `words` is what `vocabulary` returned. A null text counts as empty; null ids and repeated rows
    are kept.
    """

    def make():
        encode, kind = words.value.encoder(), words.value.kind

        def work(texts):
            packed = [np.array([*encode(t or ""), END], kind) for t in texts.to_pylist()]
            return [[p.tobytes() for p in packed], [len(p) for p in packed]]

        return work

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return annotate(slim, [F.col("text")], make, "ids binary, tokens long", carry=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "ids", "tokens")
