"""Order MinHash fingerprints: signatures that follow edit distance, not only shared content.

Every character k-mer is numbered by its occurrence in the text and hashed. The hashes are dealt into
slots by their value (one permutation split into slots, instead of one permutation a slot, so that the
cost does not grow with the number of slots). Of each slot the smallest hashes are selected, put back
into text order, and the tuple of their k-mers is hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, SLOTS, TUPLE = 8, 128, 2
# Rows a range of ids should hold.
RANGE_ROWS = 4_000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def fingerprint(text: str | None, k: int = K, slots: int = SLOTS, many: int = TUPLE) -> np.ndarray:
    """One 16-bit code per slot, 0 where no k-mer fell; a text shorter than k is one k-mer."""
    out = np.zeros(slots, np.uint16)
    if not text:
        return out
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(1, len(codes) - k + 1)
    kmers = np.zeros(n, np.uint64)
    for i in range(min(k, len(codes))):
        kmers = kmers * _ODD + codes[i : i + n]
    kmers = _mixed(kmers)
    # occurrence numbers: sort by (k-mer, position) packed into one word, count within equal k-mers
    width = np.uint64(max(1, int(n - 1).bit_length()))
    low = (np.uint64(1) << width) - np.uint64(1)
    place = np.sort((kmers & ~low) | np.arange(n, dtype=np.uint64)) & low
    kmer = kmers[place.astype(np.int64)]
    index = np.arange(n, dtype=np.int64)
    first = np.r_[True, kmer[1:] != kmer[:-1]]
    number = index - np.maximum.accumulate(np.where(first, index, 0))
    hashes = _mixed(kmer + (number.astype(np.uint64) + np.uint64(1)) * _ODD)
    slot = (hashes >> np.uint64(32)) % np.uint64(slots)
    order = _smallest(slot, hashes >> np.uint64(7), slots, many)
    chosen = slot[order]
    rank = np.arange(len(order)) - np.searchsorted(chosen, chosen)
    order = order[rank < many]
    chosen = slot[order]
    order = order[np.lexsort((place[order], chosen))]
    chosen, codes = slot[order].astype(np.int64), kmer[order]
    rank = np.arange(len(order)) - np.searchsorted(chosen, chosen)
    tuples = np.zeros(slots, np.uint64)
    for r in range(many):
        at = rank == r
        tuples[chosen[at]] = _mixed(tuples[chosen[at]] * _ODD + codes[at] + np.uint64(r + 1))
    held = np.zeros(slots, bool)
    held[chosen] = True
    out[held] = (tuples[held] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    return out


def _smallest(slot: np.ndarray, hashes: np.ndarray, slots: int, many: int) -> np.ndarray:
    """Indices sorted by (slot, hash) that hold at least the `many` smallest of every slot.

    `hashes` have 57 bits. Long texts sort only hashes so small that every slot has enough of them;
    where one slot hasn't, all are sorted, so the result is the same.
    """
    key = (slot << np.uint64(57)) | hashes
    share = 8 * many * slots / len(key)
    if share < 0.5:
        low = np.flatnonzero(hashes < np.uint64(int(share * (1 << 57))))
        if (np.bincount(slot[low].astype(np.int64), minlength=slots) >= many).all():
            return low[np.argsort(key[low])]
    return np.argsort(key)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal codes among slots that either text fills; two empty texts are alike (1)."""
    either = (a > 0) | (b > 0)
    n = int(either.sum())
    return float(((a == b) & either).sum() / n) if n else 1.0


def _hex(codes: np.ndarray) -> str:
    return codes.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _walk(batches: Iterator[pa.RecordBatch], settings: dict) -> Iterator[pa.RecordBatch]:
    """Each row with the one behind it, over rows sorted by range; copies only follow, never lead."""
    before = None
    for batch in batches:
        out: list[tuple] = []
        for at, copy, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if before is not None and before[0] == at:
                _, _, text_before, print_before = before
                mine = fingerprint(text, **settings)
                changed = edited(text_before, text)
                other = fingerprint(changed, **settings)
                out.append((before[1], len(text_before), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                            _hex(print_before), _hex(other), likeness(print_before, other), likeness(print_before, mine)))
            elif not copy:
                mine = fingerprint(text, **settings)
            before = None if copy else (at, doc_id, text, mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(_KINDS)], names=[c.split()[0] for c in OUT.split(", ")])


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", range_rows: int = RANGE_ROWS,
                 **settings) -> DataFrame:
    """Fingerprint of every whole text and of its edited form, with their likeness.

    The next document is the one with the next larger id, and the first one after the last; rows that
    share an id follow each other in order of their texts' hashes, and rows without an id come first,
    ordered likewise. A single document is its own next. Null texts are empty, and an empty table
    gives an empty result. Ids are cut into ranges of about `range_rows` rows; each range is sorted
    and walked once, with copies of the first rows of the range behind it, so every text crosses the
    network once. Only the first id of each range reaches the driver.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("known", F.col("doc_id").isNotNull()).withColumn("key", F.coalesce("doc_id", F.xxhash64("text")))
    ids = rows.select("known", "key")
    ranges = ids.count() // range_rows + 1
    cuts = (
        ids.repartitionByRange(ranges, "known", "key").groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min(F.struct("known", "key")).alias("least")).collect()
    )
    edges = sorted(tuple(r.least) for r in cuts)
    unknown = sum(not known for known, _ in edges)
    firsts = docs.sparkSession.sparkContext.broadcast(np.array([k for _, k in edges], np.int64))

    @F.pandas_udf("array<struct<at:int,copy:boolean>>")
    def placed(known: pd.Series, key: pd.Series) -> pd.Series:
        k, e = key.to_numpy(np.int64), firsts.value
        at = np.where(known.to_numpy(bool), unknown + np.searchsorted(e[unknown:], k, "right"),
                      np.searchsorted(e[:unknown], k, "right")) - 1
        leads = e[at] == k
        return pd.Series([
            [{"at": a, "copy": False}, {"at": (a - 1) % len(e), "copy": True}] if first else [{"at": a, "copy": False}]
            for a, first in zip(at.tolist(), leads.tolist(), strict=True)
        ])

    return (
        rows.select(F.explode(placed("known", "key")).alias("r"), "known", "key", "doc_id", "text")
        .repartition("r.at").sortWithinPartitions("r.at", "r.copy", "known", "key", F.xxhash64("text"))
        .select("r.at", "r.copy", "doc_id", "text").mapInArrow(lambda b: _walk(b, settings), OUT)
    )
