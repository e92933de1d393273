"""SimHash near-dedup: 64-bit fingerprints linked through pigeonring filtering.

A fingerprint is cut into a ring of equal segments. If two fingerprints differ in at most `budget`
bits, some segment starts a chain in which the first l segments together differ in at most
floor(l * budget / segments) bits, for every l. The first two lengths serve as an index: one side is
filed under the exact bits of two neighbouring segments, the other under every pattern that the
budgets of length one and two allow. Longer chains prune the candidates before the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import Stored, annotate, join_counted, stored
from playmart.llm.components import connected_components

SEED = 42
# Exact members of one key that are compared in one block; larger keys are split into blocks.
BLOCK = 2048


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """The majority bits of the XXH64 of all word shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n, k = len(words), words_per_shingle
    if not n:
        return 0
    line = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if n <= k:
        return hashed(line, SEED)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - k + 1].tolist()
    hashes = np.array([hashed(line[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text: str = "text", words_per_shingle: int = 3, carry: list[str] | None = None) -> DataFrame:
    """`row` (all columns of docs, or those in `carry`) and `fp` (the fingerprint's 64 bits as a signed long)."""

    def make():
        def work(texts):
            found = [fingerprint(t, words_per_shingle) for t in texts.to_pylist()]
            return [np.array(found, np.uint64).view(np.int64)]

        return work

    return annotate(docs, [F.col(text)], make, "fp long", carry)


def _masks(bits: int, first: int, two: int) -> list[int]:
    """Patterns over two segments of `bits` bits: at most `first` ones in the leading, `two` in all."""
    found = []
    for n in range(two + 1):
        for at in combinations(range(2 * bits), n):
            if sum(x >= bits for x in at) <= first:
                found.append(sum(1 << x for x in at))
    return found


def _key(fp: Column, i: int, segments: int, bits: int) -> Column:
    """Ring position, segment i and segment i + 1 in one long."""
    def part(j: int) -> Column:
        return F.shiftrightunsigned(fp, bits * (j % segments)).bitwiseAND(F.lit((1 << bits) - 1))

    return F.lit(i << (2 * bits)) + F.shiftleft(part(i), bits) + part(i + 1)


def pigeonring_edges(points: DataFrame, budget: int = 3, segments: int = 4) -> DataFrame:
    """Edges (a, b) that join everything linked by at most `budget` differing bits.

    `points`: node (long) and fp (long), each fp once. For every key the members are compared in
    blocks (exact members, at most about BLOCK a block, against the stream of the others), and the
    links found there leave as a spanning forest: no link between components is lost, and the number
    of edges is at most the number of rows filed. A key with very many members is dealt out as
    several blocks.
    """
    if 64 % segments or budget >= segments * 2 or segments < 3:
        raise ValueError("segments must divide 64, be 3 or more, and leave the budget under two a segment")
    bits = 64 // segments
    fp = F.col("fp")
    masks = _masks(bits, budget // segments, 2 * budget // segments)
    keys = [_key(fp, i, segments, bits) for i in range(segments)]
    exact = points.select("node", "fp", F.explode(F.array(*keys)).alias("key"))
    flips = F.array(*[F.lit(m).cast("long") for m in masks])

    def allowed(key: Column) -> Column:
        return F.transform(flips, lambda m: key.bitwiseXOR(m))

    near = points.select("node", "fp", F.explode(F.flatten(F.array(*map(allowed, keys)))).alias("key"))
    hot = stored(
        exact.groupBy("key").count().filter(F.col("count") > BLOCK)
        .select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "hot-keys",
    ).rows
    n_hot = hot.count()
    if n_hot:
        exact = join_counted(exact, hot, "key", "left", n_hot).select(
            "node", "fp", "key", F.coalesce(F.pmod(F.xxhash64("fp"), F.col("blocks")), F.lit(0)).cast("int").alias("block"))
        near = join_counted(near, hot, "key", "left", n_hot).select(
            "node", "fp", "key", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"))
    else:
        exact, near = exact.withColumn("block", F.lit(0)), near.withColumn("block", F.lit(0))
    filed = exact.withColumn("near", F.lit(False)).union(near.withColumn("near", F.lit(True)).select("node", "fp", "key", "block", "near"))
    dealt = filed.repartition("key", "block").sortWithinPartitions("key", "block", "near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in _runs(batches, budget, segments, bits):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _runs(batches, budget: int, segments: int, bits: int):
    """Edges of each batch of sorted rows; the exact members of an open key are carried on."""
    held = None  # key, block, nodes, fps of the exact members of the last key
    for batch in batches:
        node, fp, key, block, near = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if not len(node):
            continue
        fp = fp.view(np.uint64)
        if held is not None and (key[0], block[0]) == held[:2]:
            n = len(held[2])
            node, fp = np.concatenate([held[2], node]), np.concatenate([held[3], fp])
            key, block = np.concatenate([np.full(n, held[0]), key]), np.concatenate([np.full(n, held[1], block.dtype), block])
            near = np.concatenate([np.zeros(n, bool), near])
        cut = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
        starts, ends = np.r_[0, cut], np.r_[cut, len(key)]
        n_near = np.add.reduceat(near.astype(np.int64), starts)
        n_exact = ends - starts - n_near
        last = slice(starts[-1], starts[-1] + n_exact[-1])
        held = (key[starts[-1]], block[starts[-1]], node[last].copy(), fp[last].copy())
        made = _single(node, fp, key, starts, n_exact, n_near, budget, segments, bits)
        if made is not None:
            yield made
        for s, e, v in zip(*(x[(n_exact > 1) & (n_near > 0)] for x in (starts, n_exact, n_near)), strict=True):
            ring = int(key[s]) >> (2 * bits)
            yield from _forest(node[s : s + e], fp[s : s + e], node[s + e : s + e + v], fp[s + e : s + e + v],
                               lambda x, ring=ring: _linked(x, ring, budget, segments, bits))


def _linked(diff: np.ndarray, ring: int | np.ndarray, budget: int, segments: int, bits: int) -> np.ndarray:
    """Chains of three segments and more within their budgets, then the full Hamming check."""
    turn = np.asarray(ring * bits, np.uint64)
    turned = np.where(turn == 0, diff, (diff >> turn) | (diff << ((np.uint64(64) - turn) % np.uint64(64))))
    good = np.ones(diff.shape, bool)
    for length in range(3, segments + 1):
        chain = np.uint64((1 << (bits * length)) - 1)
        good &= np.bitwise_count(turned & chain) <= length * budget // segments
    return good


def _single(node, fp, key, starts, n_exact, n_near, budget, segments, bits):
    """All keys with one exact member at once: each other row against it."""
    pick = np.flatnonzero((n_exact == 1) & (n_near > 1))
    if not len(pick):
        return None
    runs, size = starts[pick], n_near[pick]
    left = np.repeat(runs, size)
    right = left + 1 + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    good = _linked(fp[left] ^ fp[right], key[left] >> (2 * bits), budget, segments, bits) & (node[left] != node[right])
    return node[left[good]], node[right[good]]


def _forest(nodes, fps, others, other_fps, linked):
    """Spanning edges of the links between exact members and others, block by block."""
    label = np.arange(len(nodes))  # exact members joined so far through some other row
    for at in range(0, len(others), BLOCK):
        n, f = others[at : at + BLOCK], other_fps[at : at + BLOCK]
        match = linked(fps[:, None] ^ f[None, :])
        hit = match.any(axis=0)
        match, n = match[:, hit], n[hit]
        if not len(n):
            continue
        while True:  # smallest label on either side, until nothing moves
            mine = np.where(match, label[:, None], len(nodes)).min(axis=0)
            new = np.minimum(label, np.where(match, mine[None, :], len(nodes)).min(axis=1))
            new = np.minimum(new, new[new])
            if (new == label).all():
                break
            label = new
        roots = nodes[mine]
        keep = roots != n
        yield roots[keep], n[keep]
    moved = label != np.arange(len(nodes))
    if moved.any():
        yield nodes[label[moved]], nodes[moved]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_per_shingle: int = 3,
                    budget: int = 3, segments: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most `budget` differing bits.
    Null and empty texts have fingerprint zero and link like any other; rows without an id get a
    null component. Repeated rows give repeated results. Other columns are not read.
    """
    prints = stored(
        with_fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "text", words_per_shingle, ["doc_id"])
        .select(F.col("row.doc_id").alias("doc_id"), "fp"), "fingerprints",
    ).rows
    points = stored(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "points").rows
    edges: Stored = stored(pigeonring_edges(points.select("node", "fp"), budget, segments), "links")
    labels = connected_components(edges.rows)
    named = points.join(labels.rows, "node", "left").select("fp", F.coalesce("label", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of docs without those that another document of their component stands for."""
    gone = (
        near_duplicates(docs, doc_id, text, **how).filter("component_id != doc_id")
        .select(F.col("doc_id").alias("_gone"))
    )
    kept = docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
    return kept.dropDuplicates([doc_id, text])
