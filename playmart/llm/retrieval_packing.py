"""Lexical retrieval packing: neighbours found by BM25 fill the window behind a seed document.

Documents are dealt by a hash into shards of a bounded number of tokens. Each shard has an inverted
index over token ids, weighted with the document frequencies and the mean length of the whole corpus.
Within a shard a document opens a window; unused documents follow in order of their BM25 score for it
until the window is full. The document at the edge is cut, and what is left of it opens the next window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import stored
from playmart.llm.tokens import tokenized, vocabulary

WINDOW = 1024
SHARD_TOKENS = 1_000_000
K1, B = 1.2, 0.75
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class ShardIndex:
    """BM25 postings of one shard; terms that more than half of the corpus holds weigh nothing."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        terms, owners, weights = [], [], []
        self.terms: list[np.ndarray] = []
        for i, ids in enumerate(docs):
            term, n = np.unique(ids, return_counts=True)
            good = idf[term] > 0
            term, n = term[good], n[good]
            self.terms.append(term)
            terms.append(term)
            owners.append(np.full(len(term), i))
            weights.append(idf[term] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(ids) / mean_length)))
        term = np.concatenate(terms)
        order = np.argsort(term, kind="stable")
        self.owner, self.weight = np.concatenate(owners)[order], np.concatenate(weights)[order]
        self.first = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.size = len(docs)

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document of the shard for the distinct terms of one of them."""
        term = self.terms[doc]
        a, n = self.first[term], self.first[term + 1] - self.first[term]
        total = int(n.sum())
        if not total:
            return np.zeros(self.size)
        at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(total)
        return np.bincount(self.owner[at], self.weight[at], self.size)


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece, in order of sequences."""
    index = ShardIndex(docs, idf, mean_length)
    unused = np.ones(len(docs), bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, room, next_free = 0, window, 0
    queue = iter(())

    def place(doc: int, start: int) -> tuple[int, int]:
        """Put in what fits; returns the start of what is left."""
        nonlocal room
        n = min(room, len(docs[doc]) - start)
        pieces.append((doc, start, n, sequence, window - room))
        room -= n
        return start + n

    current = start = None
    while True:
        if room == 0:
            sequence, room = sequence + 1, window
            if current is not None and start < len(docs[current]):
                start = place(current, start)
                if room:
                    queue = _ranked(index.scores(current), unused)
                continue
            current = None
        if current is None:  # a new seed
            while next_free < len(docs) and not unused[next_free]:
                next_free += 1
            if next_free == len(docs):
                return pieces
            current, seed = next_free, True
        else:
            current, seed = next(queue, None), False
            if current is None:
                continue
        unused[current] = False
        start = place(current, 0)
        if seed and room:
            queue = _ranked(index.scores(current), unused)


def _ranked(scores: np.ndarray, unused: np.ndarray) -> Iterator[int]:
    """Unused documents with a score, best first, ties by position; a few at a time."""
    scores = np.where(unused, scores, 0)
    taken, many = 0, 8
    while True:
        n = min(many, len(scores))
        top = np.argpartition(-scores, n - 1)[:n] if n < len(scores) else np.arange(n)
        edge = scores[top].min()
        top = np.flatnonzero(scores >= edge) if edge > 0 else np.flatnonzero(scores > 0)
        top = top[np.lexsort((top, -scores[top]))]
        for i in top[taken:].tolist():
            yield i
        if edge <= 0 or n == len(scores):
            return
        taken, many = len(top), many * 8


def _term_counts(batches: Iterator[pa.RecordBatch], kind: str, size: int) -> Iterator[pa.RecordBatch]:
    df = np.zeros(size, np.int64)
    for batch in batches:
        for ids in batch.column(0).to_pylist():
            df[np.unique(np.frombuffer(ids, kind))] += 1
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS, tokenizer_path: str | None = None) -> DataFrame:
    """Every token of every document in exactly one piece of exactly one sequence.

    Returns doc_id, start, length, doc_tokens, sequence_id, offset and ids (the piece's tokens as
    little-endian unsigned 32-bit integers). Sequences hold at most `window` tokens and only the last
    of a shard can hold fewer. A null or empty text is its end mark alone; repeated rows are packed
    as often as they occur, rows without an id too. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    words = vocabulary(spark, tokenizer_path)
    kind, size = words.value.kind, words.value.size
    made = stored(
        tokenized(docs, words, doc_id, text).withColumn("at", F.monotonically_increasing_id()), "token-ids", "zstd"
    ).rows
    n, total = made.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    # one row per term of the vocabulary at most, whatever the corpus
    counts = (
        made.select("ids").mapInArrow(lambda b: _term_counts(b, kind, size), "term long, df long")
        .groupBy("term").agg(F.sum("df").alias("df")).collect()
    )
    df = np.zeros(size, np.int64)
    for row in counts:
        df[row.term] = row.df
    idf = np.maximum(0, np.log((n - df + 0.5) / (df + 0.5))) * (df > 0)
    statistics = spark.sparkContext.broadcast((idf, total / max(n, 1)))
    shards = total // shard_tokens + 1

    def shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at", ignore_index=True)
        tokens = [np.frombuffer(x, kind) for x in rows["ids"]]
        weights, mean = statistics.value
        pieces = pack_shard(tokens, weights, mean, window)
        doc, start, length, sequence, offset = (list(x) for x in zip(*pieces, strict=True))
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(rows["doc_id"].to_numpy()[doc], ~rows["known"].to_numpy()[doc]), "start": start, "length": length,
            "doc_tokens": [len(tokens[d]) for d in doc],
            "sequence_id": (int(key[0]) << 32) + np.array(sequence, np.int64), "offset": offset,
            "ids": [tokens[d][s : s + n].astype("<u4").tobytes() for d, s, n in zip(doc, start, length, strict=True)],
        })

    return (
        made.select(F.pmod(F.xxhash64("at"), F.lit(shards)).alias("shard"), "at", F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
                    F.col("doc_id").isNotNull().alias("known"), "ids")
        .groupBy("shard").applyInPandas(shard, PIECES)
    )
