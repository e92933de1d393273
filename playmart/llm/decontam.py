"""Benchmark decontamination: pigeonhole pieces, exact piece hits, Myers' bit-parallel distance.

Texts are words (runs of letters and digits, case folded). An item of n words may differ from a
passage in at most `errors(n)` words inserted, removed or replaced; cut into one piece more than that,
at least one piece must occur unchanged. Every such hit opens a window of the document, which Myers'
algorithm, with words as its alphabet, scans for the best approximate occurrence of the item.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import annotate

WORD = re.compile(r"\w+")
SIMILARITY = 0.8
# Benchmark words that one pass over the documents carries to every task; a larger benchmark takes
# more passes, so the memory of driver and tasks does not grow with it.
WORDS_PER_PASS = 2_000_000
HITS = "array<struct<item_id:bigint,distance:int,first_word:int,end_word:int>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower().replace("_", " ")) if text else []


def errors(n: int, similarity: float = SIMILARITY) -> int:
    """Word edits an item of n words may carry."""
    return int(n * (1 - similarity) + 1e-9)


def best_occurrence(pattern: list[int], text: list[int], budget: int) -> tuple[int, int] | None:
    """(distance, end) of the nearest occurrence of pattern in text, the first of equals.

    Myers' recurrence over one Python integer of len(pattern) bits; None if over budget.
    """
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, None
    for j, w in enumerate(text):
        eq = masks.get(w, 0)
        x = eq | minus
        d0 = ((((x & plus) + plus) ^ plus) | x) & full
        up, down = minus | ~(d0 | plus) & full, plus & d0
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(d0 | up) & full, up & d0
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


@dataclass
class Index:
    """Items of one pass: word numbers, and where each piece lies."""

    words: dict[str, int] = field(default_factory=dict)
    items: list[tuple[int | None, list[int], int]] = field(default_factory=list)  # id, words, budget
    pieces: dict[int, dict[tuple[int, ...], list[tuple[int, int]]]] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]], similarity: float) -> Index:
        index = cls()
        for item_id, text in rows:
            ids = [index.words.setdefault(w, len(index.words) + 1) for w in words_of(text)]
            if not ids:
                continue
            k = errors(len(ids), similarity)
            at = np.linspace(0, len(ids), k + 2).astype(int)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                found = index.pieces.setdefault(b - a, {}).setdefault(tuple(ids[a:b]), [])
                found.append((len(index.items), a))
            index.items.append((item_id, ids, k))
        return index

    def keys(self) -> dict[int, np.ndarray]:
        """Hashes of the pieces of each length, sorted."""
        return {p: np.unique(_rolled(np.array(list(by), np.uint64).T)) for p, by in self.pieces.items()}


def _rolled(columns) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = h * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(1)
        h ^= h >> np.uint64(29)
    return h


def occurrences(text: str | None, index: Index, keys: dict[int, np.ndarray]) -> list[tuple[int | None, int, int, int]]:
    """(item id, distance, first word, end word) of each item's nearest occurrence in the whole text.

    The end is that of the first of the nearest occurrences; the first word is the start of the
    window in which it was found, moved to the item's length before the end.
    """
    words = words_of(text)
    ids = np.fromiter(map(index.words.get, words, repeat(0)), np.uint64, len(words))
    seen = np.concatenate([[0], np.cumsum(ids > 0)])
    windows: dict[int, list[tuple[int, int]]] = {}
    for p, known in keys.items():
        n = len(ids) - p + 1
        if n <= 0:
            continue
        # a piece has no unknown word, so only stretches of p known words are hashed
        at = np.flatnonzero(seen[p:] - seen[:-p] == p)
        if not len(at):
            continue
        h = _rolled([ids[at + i] for i in range(p)])
        place = np.minimum(np.searchsorted(known, h), len(known) - 1)
        for pos in at[known[place] == h].tolist():
            for item, offset in index.pieces[p].get(tuple(ids[pos : pos + p].tolist()), ()):
                _, words, k = index.items[item]
                start = pos - offset
                windows.setdefault(item, []).append((max(0, start - k), min(len(ids), start + len(words) + k)))
    found = []
    for item, spans in windows.items():
        item_id, words, k = index.items[item]
        best = None
        for a, b in _merged(spans):
            hit = best_occurrence(words, ids[a:b].tolist(), k)
            if hit and (best is None or hit[0] < best[0]):
                best = (hit[0], a + hit[1])
        if best:
            found.append((item_id, best[0], max(0, best[1] - len(words)), best[1]))
    return sorted(found, key=_order)


def _order(found: tuple) -> tuple:
    """Tuples that begin with an item id, those without one first, as Spark sorts them."""
    return found[0] is not None, found[0] or 0, *found[1:]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _passes(benchmark: DataFrame, item_id: str, text: str, per_pass: int):
    """The benchmark in parts of about `per_pass` words, each small enough for every task."""
    items = benchmark.filter(F.col(text).isNotNull()).select(
        F.col(item_id).cast("long").alias("i"), F.col(text).alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = total // (6 * per_pass) + 1
    for part in range(parts):
        chosen = items if parts == 1 else items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part)
        yield [(r[0], r[1]) for r in chosen.distinct().collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", similarity: float = SIMILARITY, per_pass: int = WORDS_PER_PASS) -> DataFrame:
    """`row` (all columns of docs) and `leaks`: an array of (item_id, distance, first_word, end_word).

    Every item found in the text with at most errors(n) word edits is listed once, by item id; an item
    without an id counts like any other and is listed with a null id. Null and empty texts, and an empty benchmark, give an empty array; items without words match nothing.
    """
    found = None
    for rows in _passes(benchmark, item_id, item_text, per_pass):
        broadcast = docs.sparkSession.sparkContext.broadcast(Index.of(sorted(rows, key=_order), similarity))

        def make(broadcast=broadcast):
            index = broadcast.value
            keys = index.keys()

            def work(texts):
                return [[[dict(zip(("item_id", "distance", "first_word", "end_word"), hit, strict=True))
                          for hit in occurrences(t, index, keys)] for t in texts.to_pylist()]]

            return work

        if found is None:
            found = annotate(docs, [F.col(text)], make, f"leaks {HITS}")
        else:
            wide = annotate(found, [F.col(f"row.{text}")], make, f"leaks {HITS}")
            found = wide.select("row.row", F.array_sort(F.concat("row.leaks", "leaks")).alias("leaks"))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of docs in which no benchmark item occurs."""
    return find_leaks(docs, benchmark, **how).filter(F.size("leaks") == 0).select("row.*")
