"""Best-fit-decreasing packing into id matrices, with a segment tree over the free capacities.

Documents are dealt by a hash into shards whose number of text bytes, and so of tokens, is bounded.
A document longer than the window is cut into full windows and one rest. Within a shard, pieces go in
decreasing length into the sequence with the least room that still holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.tokens import END, tokenized, vocabulary

WINDOW = 1024
SHARD_BYTES = 4_000_000
SEQUENCES = (
    "sequence_id long, tokens long, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, doc_starts array<bigint>"
)


class Capacities:
    """Open sequences filed by free room; the leaf counts of a segment tree find the tightest fit."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        at = self.leaves + room
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, sequence) of the smallest room of at least `least`, or None."""
        at = self.leaves + least
        if not self.count[at]:
            while at > 1 and not (at % 2 == 0 and self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at + (not self.count[2 * at])
        room = at - self.leaves
        self._change(room, -1)
        return room, self.open[room].pop()


def pack_lengths(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); every token of every document exactly once."""
    pieces = [(min(window, n - s), d, s) for d, n in enumerate(lengths) for s in range(0, n, window)]
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    sequences: list[list[tuple[int, int, int]]] = []
    rooms = Capacities(window)
    for n, d, s in pieces:
        fit = rooms.take(n)
        room, at = fit if fit else (window, len(sequences))
        if not fit:
            sequences.append([])
        sequences[at].append((d, s, n))
        if room > n:
            rooms.add(room - n, at)
    return sequences


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
         shard_bytes: int = SHARD_BYTES, tokenizer_path: str | None = None) -> DataFrame:
    """One row per sequence; its `ids` are `window` little-endian integers, END behind the last token.

    The rows' ids laid one under another are the packed matrix (unsigned 16-bit for vocabularies up
    to 65,536, else 32-bit). cu_seqlens: 0 and the end of every segment; position_resets: where
    position ids start again from 0, so the starts of all segments; doc_ids and doc_starts: where a
    segment comes from, its first token's place in the document. A null or empty text is its end mark
    alone; repeated rows and rows without an id (null in doc_ids) are packed like any other.
    """
    words = vocabulary(docs.sparkSession, tokenizer_path)
    kind = words.value.kind
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)) + F.count("*")).first()[0]
    shards = size // shard_bytes + 1

    def shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at", ignore_index=True)
        tokens = [np.frombuffer(x, kind) for x in rows["ids"]]
        known, names = rows["known"].tolist(), rows["doc_id"].tolist()
        made = []
        for i, segments in enumerate(pack_lengths([len(t) for t in tokens], window)):
            ids = np.full(window, END, kind)
            ends = np.cumsum([n for _, _, n in segments]).tolist()
            for (d, s, n), e in zip(segments, ends, strict=True):
                ids[e - n : e] = tokens[d][s : s + n]
            made.append((
                (int(key[0]) << 32) + i, ends[-1], ids.tobytes(), [0, *ends], [0, *ends[:-1]],
                [names[d] if known[d] else None for d, _, _ in segments], [s for _, s, _ in segments],
            ))
        return pd.DataFrame(made, columns=[c.split()[0] for c in SEQUENCES.split(", ")])

    return (
        tokenized(docs, words, doc_id, text).withColumn("at", F.monotonically_increasing_id())
        .select(F.pmod(F.xxhash64("at"), F.lit(shards)).alias("shard"), "at", F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
                F.col("doc_id").isNotNull().alias("known"), "ids")
        .groupBy("shard").applyInPandas(shard, SEQUENCES)
    )


def write_matrices(sequences: DataFrame, path: str) -> None:
    """Write packed sequences as Parquet files, ordered by sequence within each."""
    sequences.sortWithinPartitions("sequence_id").write.mode("error").parquet(path)


def unpacked(rows: Iterator, kind: str = "<u2") -> dict:
    """Documents' token ids read back from sequences, by doc id; for small results and tests."""
    parts: dict = {}
    for row in rows:
        ids = np.frombuffer(row.ids, kind)
        spans = zip(row.doc_ids, row.doc_starts, row.cu_seqlens[:-1], row.cu_seqlens[1:], strict=True)
        for doc, start, a, b in spans:
            parts.setdefault(doc, []).append((start, ids[a:b]))
    return {d: np.concatenate([x for _, x in sorted(p, key=lambda q: q[0])]) for d, p in parts.items()}
