"""Spelling variants by a variable-length gram index: words one edit apart, found through rare grams.

A word, between a sign for its start and one for its end, is cut into grams: from every place the
shortest piece of at least QMIN code points that is not a frequent one (QMAX at most, or up to the
end); a gram that lies within an earlier one is left out. The frequent pieces are the dictionary: it
holds those in more than a threshold of words, and the threshold rises with the table, so their
number has a fixed bound and every task can hold them.

One edit changes the grams over its place, and those right of it that a new, longer gram can swallow;
the most over all places is the word's bound of affected grams. All others stay, so two words one
edit apart share all but `affected` of the grams of either. It follows that they share one of the
`affected + 1` rarest grams of each, in any fixed order, and only these lists are merged. A shared gram
lies wholly left or wholly right of the edit, so what is on its other side is equal too and is part
of the list's key: lists stay short where a gram is common. In a merged list a pair is dropped if
either word has more grams the other lacks than its bound allows (read off 64-bit signatures of the
gram sets, which can only hide a difference); what is left is verified by its distance. A word all of
whose grams one edit may affect promises nothing; pairs of two such words meet under what lies left
and right of a place or of a code point. All work is linear in a word's length.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import annotate, stored

QMIN, QMAX = 2, 4
START, END = "\x02", "\x03"  # outside any word
# Frequent pieces there can be at most; they are held by the driver and by every task.
DICTIONARY = 20_000
# A piece in fewer words than this is never called frequent.
LEAST_FREQUENT = 200
# Cells of the table of gram frequencies that orders a word's grams; collisions cost pruning, never a pair.
CELLS = 1 << 18
# Distinct words a task gathers before it passes their counts on.
FLUSH = 200_000
# Pairs of words up to this length are verified in every list they meet in, longer ones once.
SHORT = 64
RUN = re.compile("[a-zÀ-ÿ]+")


def drop_one(doc_id, run: str, among: int = 199) -> str:
    """The run without one code point, in one of `among` cases told by the checksum of id and run."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % among:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 6,
                least_count: int = 5, alter: Callable | None = None) -> DataFrame:
    """word, n: runs of letters of whole texts with A-Z lower-cased, as `alter(doc_id, run)` leaves them.

    Words shorter than `least_length` code points or rarer than `least_count` are left out; a null
    text has no words. Counts are added up within a task before they cross the network.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(RUN.findall((t or "").encode("utf-8", "replace").lower().decode())).items():
                    word = alter(i, word) if alter else word
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) > FLUSH:
                    yield out()
                    total.clear()
        yield out()

    counted = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def frequent_pieces(words: DataFrame) -> set[str]:
    """Pieces of QMIN to QMAX - 1 code points in more than a threshold of words; DICTIONARY at most."""
    padded = words.select(F.concat(F.lit(START), "word", F.lit(END)).alias("w")).withColumn("size", F.char_length("w"))
    pieces = F.flatten(F.transform(
        F.sequence(F.lit(QMIN), F.least(F.lit(QMAX - 1), F.col("size"))),
        lambda q: F.transform(F.sequence(F.lit(1), F.col("size") - q + 1), lambda p: F.substring(F.col("w"), p, q))))
    counts = stored(padded.select(F.explode(F.array_distinct(pieces)).alias("piece")).groupBy("piece").agg(
        F.count("*").alias("n")).filter(F.col("n") > LEAST_FREQUENT), "gram-pieces").rows
    # fewer than total / threshold pieces can be in more than `threshold` words
    total = counts.agg(F.sum("n")).first()[0] or 0
    threshold = max(LEAST_FREQUENT, -(-total // DICTIONARY))
    return {r.piece for r in counts.filter(F.col("n") > threshold).select("piece").collect()}


class Grams:
    """Cuts words by a dictionary of frequent pieces."""

    def __init__(self, frequent: set[str]):
        self.frequent = frequent
        self.inside = {f[i:] for f in frequent for i in range(1, len(f))}

    def spans(self, w: str) -> list[tuple[int, int]]:
        """(start, end) of the grams of a word with its signs; starts and ends rise."""
        found, last, n = [], 0, len(w)
        for p in range(n - QMIN + 1):
            e = p + QMIN
            while e < n and e - p < QMAX and w[p:e] in self.frequent:
                e += 1
            if e > last:
                found.append((p, e))
                last = e
        return found

    def affected(self, w: str, spans: list[tuple[int, int]]) -> int:
        """The most grams that one edit between the signs of `w` can change or swallow."""
        most, ends = 0, [e for _, e in spans]
        for i in range(1, len(w)):
            changed, split = 0, 0  # code point i replaced or deleted; one put in before i
            for p, e in spans[bisect_right(ends, i) : bisect_right(ends, i + QMAX)]:
                if p <= i < e or p > i and w[i + 1 : e - 1] in self.inside:
                    changed += 1
                if p < i < e or p >= i and w[i : e - 1] in self.inside:
                    split += 1
            most = max(most, changed if i < len(w) - 1 else 0, split)
        return most


def _cell(gram: str) -> int:
    return xxhash.xxh64_intdigest(gram.encode(), 7) % CELLS


def _signature(grams: list[str]) -> int:
    """One bit of 64 a gram, as a signed long."""
    bits = 0
    for g in grams:
        bits |= 1 << xxhash.xxh64_intdigest(g.encode(), 3) % 64
    return bits - (bits >> 63 << 64)


def _heads(w: str) -> list[int]:
    """Hashes of w[:0], w[:1], ..., w."""
    state = xxhash.xxh64(seed=1)
    found = [state.intdigest()]
    for c in w:
        state.update(c.encode())
        found.append(state.intdigest())
    return found


def list_keys(w: str, spans: list[tuple[int, int]], chosen: set[str], open_: bool) -> list[int]:
    """The lists (signed longs) of a word with its signs: those of the chosen grams; by places if `open_`."""
    heads, tails = _heads(w), _heads(w[::-1])[::-1]  # tails[i]: of w[i:]
    keys = [pair for p, e in spans if w[p:e] in chosen for pair in ((1, heads[e]), (2, tails[p]))]
    if open_:
        keys += [(heads[i], tails[i]) for i in range(1, len(w))] + [(heads[i], tails[i + 1]) for i in range(1, len(w) - 1)]
    mixed = {(a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F ^ b >> 31) & 0xFFFFFFFFFFFFFFFF for a, b in keys}
    return [m - (m >> 63 << 64) for m in sorted(mixed)]


def gram_index(words: DataFrame) -> DataFrame:
    """word, n, grams (distinct), signature (of the grams), affected (by one edit, at most), keys (its lists)."""
    spark = words.sparkSession
    cutter = spark.sparkContext.broadcast(frequent_pieces(words))

    def cut():
        grams = Grams(cutter.value)

        def work(batch):
            spans = [(START + w + END, grams.spans(START + w + END)) for w in batch.to_pylist()]
            found = [list(dict.fromkeys(w[p:e] for p, e in s)) for w, s in spans]
            bounds = [grams.affected(w, s) for w, s in spans]
            return [found, [[_cell(g) for g in f] for f in found], list(map(_signature, found)), bounds]

        return work

    decomposed = stored(
        annotate(words.select("word", "n"), [F.col("word")], cut, "grams array<string>, cells array<int>, signature long, affected int")
        .select("row.*", "grams", "cells", "signature", "affected"), "gram-words").rows
    tally = np.zeros(CELLS, np.int64)  # one number a cell, whatever the size of the table
    for r in decomposed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).toLocalIterator():
        tally[r.cell] = r.n
    ranks = spark.sparkContext.broadcast(tally)

    def file():
        grams, tally = Grams(cutter.value), ranks.value

        def keys(word, found, cells, affected):
            w = START + word + END
            order = sorted(zip(tally[cells].tolist(), found, strict=True))
            return list_keys(w, grams.spans(w), {g for _, g in order[: affected + 1]}, affected >= len(found))

        def work(*batch):
            return [[keys(*x) for x in zip(*(b.to_pylist() for b in batch), strict=True)]]

        return work

    filed = annotate(decomposed, [F.col(c) for c in ("word", "grams", "cells", "affected")], file, "keys array<long>",
                     carry=["word", "n", "grams", "signature", "affected"])
    return filed.select("row.*", "keys")


def near_words(words: DataFrame) -> DataFrame:
    """a, b, a_n, b_n: every pair of words (a < b) that differ by one code point put in, left out or replaced."""
    index = stored(gram_index(words), "gram-index").rows
    lists = index.select(F.explode("keys").alias("key"), "word", "n", "signature", "affected", F.char_length("word").alias("size"))
    # a list of one word has no pairs
    full = lists.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1").select("key")
    lists = stored(lists.join(full, "key", "left_semi"), "gram-lists").rows
    x, y = lists.alias("x"), lists.alias("y")
    near = F.expr(f"""
        x.key = y.key and x.word < y.word and abs(x.size - y.size) <= 1
        and bit_count(x.signature & ~y.signature) <= x.affected and bit_count(y.signature & ~x.signature) <= y.affected
        and (x.size > {SHORT} or levenshtein(x.word, y.word, 1) = 1)""")
    met = x.join(y, near).select(
        F.col("x.word").alias("a"), F.col("y.word").alias("b"), F.col("x.n").alias("a_n"), F.col("y.n").alias("b_n")).distinct()
    # stored, or Spark would take the distance before the repeats are gone
    return stored(met, "spelling-met").rows.filter(F.expr(f"char_length(a) <= {SHORT} or levenshtein(a, b, 1) = 1"))


def variant_groups(words: DataFrame, times: int = 5) -> DataFrame:
    """One row per row of `words` (word, n; words distinct): n_near, form, form_n, root.

    A word's form is the near word with the largest n (ties: the smallest), if that is at least `times`
    its own n. The root is where forms lead to; n grows at every step, so there is no circle. Words
    without near ones have 0, null, null and themselves. No words give no rows.
    """
    words = stored(words.select("word", "n"), "spelling-words").rows
    pairs = near_words(words)
    both = pairs.union(pairs.select("b", "a", "b_n", "a_n"))
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    told = stored(
        words.join(best, "word", "left")
        .withColumn("strong", -F.col("best.less") >= F.col("n") * times)
        .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("strong"), F.col("best.form")).alias("form"),
                F.when(F.col("strong"), -F.col("best.less")).alias("form_n")), "spelling-forms").rows
    ahead = stored(told.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-roots").rows
    while True:  # every round doubles the steps taken; n grows `times`-fold a step, so there are few
        on = ahead.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = ahead.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = stored(moved, "spelling-roots").rows
        ahead, more = moved.select("word", "root"), not moved.filter("moved").isEmpty()
        if not more:
            break
    return told.join(ahead, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
