"""Near copies by SimHash fingerprints and by the Jaccard similarity of word shingles: a stage of the pipeline.

Texts whose SimHash fingerprints differ in three bits or fewer are linked first, exactly as `simhash.py` links
them. Copies it misses are found by similarity, looking only at texts that are not one component yet.

A text is the set of its five-word shingles. MinHash bands only propose pairs: of pairs with a
similarity of 0.8 about one in a hundred million shares none of the 60 bands of six slots, of closer
pairs fewer. One bit of each of the 360 slots makes a fingerprint; a pair at 0.8 differs in 36 bits on
average, and pairs that differ in more than DIFFER are dropped before any text is fetched. Every other
pair is confirmed by the exact similarity of all shingles, which are made once a text and compared by Spark,
so no task holds a batch of pairs of texts.

Pairs are taken in three steps, each looking only at keys whose texts are not one component yet: every
text with the first one of one of its keys; with the first ones of all its keys; with all others. The last
step is quadratic in the texts of a key that are alike without reaching the bar. Its pairs are never rows: a
key's texts meet in blocks inside tasks, first their fingerprints, then the shingles of those texts that
have a partner left, and only a spanning forest of the links comes out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import annotate, join_counted, stored
from playmart.llm.components import connected_components
from playmart.llm.simhash import fingerprint, pigeonring_edges
from playmart.session import shuffle_partitions

WORDS, SIMILARITY = 5, 0.8
BANDS, SLOTS = 60, 6
DIFFER = 70  # of the BANDS * SLOTS bits; six standard deviations above what 0.8 gives
SEED = 42
# Shingles whose slots are computed at once.
BLOCK = 2048
# Texts, and shingles of these, that a task holds of one key; a key with more is dealt out in blocks.
HELD, HELD_SHINGLES = 2048, 4_000_000

_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * SLOTS, np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, n_words: int = WORDS) -> np.ndarray:
    """Sorted distinct XXH64 of all runs of `n_words` words; of the whole line if it has fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n, line, hashed = len(words), b" ".join(words), xxhash.xxh64_intdigest
    if n <= n_words:
        return np.array([hashed(line, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - n_words + 1].tolist()
    found = [hashed(line[a:b], SEED) for a, b in zip(starts, ends[n_words - 1 :].tolist(), strict=True)]
    return np.unique(np.array(found, np.uint64))


def bands(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One key (signed long) a band, of the least hashes under SLOTS permutations each; one bit a slot, as longs."""
    least = np.full(BANDS * SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), BLOCK):
        least = np.minimum(least, (_FACTORS[:, None] * found[None, at : at + BLOCK]).min(axis=1))
    slots = least.reshape(BANDS, SLOTS)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(SLOTS):
        key = (key ^ slots[:, i] ^ (slots[:, i] >> np.uint64(29))) * _ODD
        key ^= key >> np.uint64(32)
    bits = np.zeros(-(-BANDS * SLOTS // 64) * 64, np.uint8)
    bits[: BANDS * SLOTS] = (least * _ODD) >> np.uint64(63)
    return key.view(np.int64), np.packbits(bits).view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _same(doc_id: str, text: str) -> list[Column]:
    """Two hashes that name a row's id and text; repeated rows share them."""
    both = (F.col(doc_id), F.col(text))
    return [F.xxhash64(*both).alias("h1"), F.hash(*both).alias("h2")]


def _sketched(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sizes and fingerprints allow the similarity."""
    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("size").alias(f"{name}_size"), F.col("bits").alias(f"{name}_bits"))

    size, other = F.col("a_size"), F.col("b_size")
    words = range(-(-BANDS * SLOTS // 64))
    differ = sum((F.bit_count(F.col("a_bits")[i].bitwiseXOR(F.col("b_bits")[i])) for i in words), F.lit(0))
    close = (F.least(size, other) >= F.lit(similarity) * F.greatest(size, other) - 1e-9) & (differ <= DIFFER)
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(close).select("a", "b")


def _shingled(asked: DataFrame, nodes: DataFrame, docs: DataFrame, n_words: int):
    """Stored rows node, found (its shingles) of the distinct nodes in `asked`. `docs`: h1, h2, text."""
    wanted = asked.distinct().join(nodes.select("node", F.col("first.h1").alias("h1"), F.col("first.h2").alias("h2")), "node")
    texts = docs.join(wanted, ["h1", "h2"]).select("node", "text").dropDuplicates(["node"])

    def make():
        return lambda found: [[shingles(t.as_py(), n_words).view(np.int64) for t in found]]

    return stored(annotate(texts, [F.col("text")], make, "found array<long>", carry=["node"]).select("row.node", "found"), "near-shingles")


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n_words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are at least so similar. `docs`: h1, h2, text."""
    held = _shingled(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), nodes, docs, n_words)
    both = (
        pairs.join(held.rows.select(F.col("node").alias("a"), F.col("found").alias("x")), "a")
        .join(held.rows.select(F.col("node").alias("b"), F.col("found").alias("y")), "b")
    )
    shared = F.size(F.array_intersect("x", "y"))  # the shingles of a text are distinct
    enough = shared / (F.size("x") + F.size("y") - shared) >= similarity
    links = stored(both.filter(enough).select("a", "b"), "near-links").rows
    held.drop()
    return links


class _Texts(NamedTuple):
    """Texts filed under one key, as arrays; `found` is empty while only fingerprints are compared."""

    node: np.ndarray
    label: np.ndarray
    size: np.ndarray
    bits: np.ndarray
    keys: np.ndarray
    found: list

    def part(self, start: int, end: int) -> _Texts:
        return _Texts(*(column[start:end] for column in self))

    def plus(self, other: _Texts) -> _Texts:
        return _Texts(*(np.concatenate(pair) for pair in zip(self[:5], other[:5], strict=True)), self.found + other.found)


def _read(batch: pa.RecordBatch) -> _Texts:
    column = {name: batch.column(name) for name in batch.schema.names}
    n = batch.num_rows
    node, label, size = (column[name].to_numpy(zero_copy_only=False) for name in ("node", "label", "size"))
    bits, keys = (column[name].flatten().to_numpy().reshape(n, -1) for name in ("bits", "keys"))
    found = np.split(column["found"].flatten().to_numpy().view(np.uint64), np.cumsum(size)[:-1]) if "found" in column else []
    return _Texts(node, label.copy(), size, bits.view(np.uint64), keys, found)


def _alike(x: _Texts, y: _Texts, key: int, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of x and of y, tile by tile, that are not joined yet and whose sizes and fingerprints allow the similarity.

    A pair is taken at the first of the keys it shares only. If x is y, each pair comes once.
    """
    for s in range(0, len(x.node), 256):
        p = x.part(s, s + 256)
        for t in range(s if x is y else 0, len(y.node), HELD):
            q = y.part(t, t + HELD)
            good = p.label[:, None] != q.label
            if x is y:
                good &= np.arange(s, s + len(p.node))[:, None] < np.arange(t, t + len(q.node))
            if not good.any():
                continue
            good &= np.minimum(p.size[:, None], q.size) >= similarity * np.maximum(p.size[:, None], q.size) - 1e-9
            differ = np.zeros(good.shape, np.uint16)
            for w in range(p.bits.shape[1]):
                differ += np.bitwise_count(p.bits[:, w, None] ^ q.bits[:, w])
            rows, others = np.nonzero(good & (differ <= DIFFER))
            for at in range(0, len(rows), 1 << 15):
                i, j = rows[at : at + (1 << 15)], others[at : at + (1 << 15)]
                mine = p.keys[i, (p.keys[i] == q.keys[j]).argmax(axis=1)] == key
                if mine.any():
                    yield i[mine] + s, j[mine] + t


def _hits(x: _Texts, y: _Texts, key: int, similarity: float) -> list[tuple]:
    """key and nodes of the rows that have a partner."""
    left, right = np.zeros(len(x.node), bool), np.zeros(len(y.node), bool)
    for i, j in _alike(x, y, key, similarity):
        left[i] = right[j] = True
    nodes = np.unique(np.concatenate([x.node[left], y.node[right]]))
    return [(np.full(len(nodes), key), nodes)] if len(nodes) else []


def _forest(x: _Texts, y: _Texts, key: int, similarity: float) -> list[tuple]:
    """Links (a, b) that join what has at least the similarity; the labels of both sides follow."""
    links = []
    for i, j in _alike(x, y, key, similarity):
        rows, starts = np.unique(i, return_index=True)
        for row, others in zip(rows, np.split(j, starts[1:]), strict=True):
            others = others[y.label[others] != x.label[row]]
            if not len(others):
                continue
            mine, theirs, sizes = x.found[row], np.concatenate([y.found[o] for o in others]), y.size[others]
            at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            shared = np.add.reduceat((mine[at] == theirs).astype(np.int64), np.cumsum(sizes) - sizes)
            others = others[shared / (len(mine) + sizes - shared) >= similarity]
            labels, first = np.unique(y.label[others], return_index=True)
            if len(labels):
                links.append((np.full(len(labels), x.node[row]), y.node[others[first]]))
                label = x.label[row]
                x.label[np.isin(x.label, labels)] = label
                y.label[np.isin(y.label, labels)] = label
    return links


def _met(filed: DataFrame, weight: Column, compare, names: str, similarity: float) -> DataFrame:
    """Two longs a row: what `compare` makes of the texts of each key, block against block.

    `filed`: key, node, label, size, bits, keys, found if `compare` asks for it. A key whose `weight` is more
    than 1 is dealt into blocks: a block's texts are held and meet each other and, one batch after the other, those of
    all later blocks. So a task holds one block and one batch, and every two texts of a key meet once.
    """
    large = stored(filed.groupBy("key").agg(F.ceil(F.sum(weight)).cast("int").alias("blocks")).filter("blocks > 1"), "near-blocks").rows
    n_large = large.count()
    own = F.lit(0)
    if n_large:
        filed = join_counted(filed, large, "key", "left", n_large)
        own = F.coalesce(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.lit(0))
    columns = [c for c in ("node", "label", "size", "bits", "keys", "found") if c in filed.columns]
    dealt = (
        filed.select("key", own.alias("own"), *columns).withColumn("block", F.explode(F.sequence(F.lit(0), "own")))
        .select("key", "block", (F.col("block") < F.col("own")).alias("later"), *columns)
        .repartition(shuffle_partitions(filed.sparkSession), "key", "block").sortWithinPartitions("key", "block", "later")
    )
    a, b = names.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, made = _read(batch), []
            key, block, later = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cut = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (later[1:] != later[:-1])) + 1
            for s, e in zip(np.r_[0, cut], np.r_[cut, len(key)], strict=True):
                mine = rows.part(s, e)
                if at != (key[s], block[s]):
                    held, at = None, (key[s], block[s])
                if held is not None:
                    made += compare(held, mine, key[s], similarity)
                if not later[s]:
                    made += compare(mine, mine, key[s], similarity) if e - s > 1 else []
                    held = mine if held is None else held.plus(mine)
            found = [np.concatenate(c) for c in zip(*made, strict=True)] if made else [np.zeros(0, np.int64)] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=[a, b])

    return dealt.mapInArrow(run, f"{a} long, {b} long")


def _all_met(filed: DataFrame, nodes: DataFrame, docs: DataFrame, n_words: int, similarity: float) -> DataFrame:
    """Links (a, b) that join all texts filed (key, node, label) under one key that are at least so similar."""
    filed = filed.join(nodes.select("node", "size", "bits", "keys"), "node")
    hits = stored(_met(filed, F.lit(1 / HELD), _hits, "key node", similarity).distinct(), "near-hits").rows
    held = _shingled(hits.select("node"), nodes, docs, n_words)
    weight = F.greatest(F.lit(1 / HELD), F.col("size") / HELD_SHINGLES)
    links = stored(_met(filed.join(hits, ["key", "node"]).join(held.rows, "node"), weight, _forest, "a b", similarity), "near-links").rows
    held.drop()
    return links


def _fingerprint_links(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) that join the nodes of texts whose fingerprints differ in SimHash's budget or less."""
    known = stored(prints.select("same", "fp").distinct().join(nodes.select("same", "node"), "same").select("node", "fp"), "near-fingerprints").rows
    points = stored(known.groupBy("fp").agg(F.min("node").alias("first")), "points").rows
    equal = known.join(points, "fp").filter("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    # a node may hold several fingerprints, so points are named by their own and told their nodes again
    found = stored(pigeonring_edges(points.select(F.col("fp").alias("node"), "fp")), "links").rows
    a, b = points.toDF("a", "x"), points.toDF("b", "y")
    near = found.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).filter("a != b")
    return stored(equal.union(near).distinct(), "near-links").rows


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_words: int = WORDS,
                similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of docs: h1, h2 (hashes of id and text), component and stays.

    A component holds what is joined by fingerprints or by links of at least `similarity`. `stays` is true for the row
    with the smallest id (rows without an id come last) and its repeats.
    """
    def make():
        def work(texts):
            size, same, keys, bits, fps = [], [], [], [], []
            for t in texts:
                found = shingles(t.as_py(), n_words)
                key, bit = bands(found)
                fps.append(fingerprint(t.as_py()))
                size.append(len(found)), same.append(xxhash.xxh3_128_digest(found.tobytes())), keys.append(key), bits.append(bit)
            return [size, same, keys, bits, np.array(fps, np.uint64).view(np.int64)]

        return work

    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *_same(doc_id, text))
    prints = stored(
        annotate(keyed, [F.col("text")], make, "size long, same binary, keys array<long>, bits array<long>, fp long", carry=["doc_id", "h1", "h2"])
        .select("row.*", "size", "same", "keys", "bits", "fp"), "shingle-prints")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "h1", "h2")
    nodes = stored(
        prints.rows.groupBy("same").agg(F.min(first).alias("first"), F.first("size").alias("size"), F.first("keys").alias("keys"),
                                        F.first("bits").alias("bits"))
        .withColumn("node", F.monotonically_increasing_id()), "shingle-nodes").rows
    rows = stored(prints.rows.select("h1", "h2", "same"), "near-rows").rows
    links = _fingerprint_links(prints.rows, nodes)
    label = connected_components(links).rows
    prints.drop()
    filed = nodes.select("node", F.explode("keys").alias("key"))
    heads = filed.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1")
    met = stored(filed.join(heads.select("key", "a"), "key"), "shingle-keys")
    source = keyed.select("h1", "h2", "text")

    def open_keys() -> DataFrame:
        named = met.rows.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("key")
        return stored(named.join(mixed, "key"), "near-open").rows

    left = open_keys()
    apart = left.join(left.select(F.col("node").alias("head"), F.col("label").alias("top")).distinct(), F.col("a") == F.col("head"))
    tried = stored(apart.filter("label != top").groupBy(F.col("node").alias("b")).agg(F.min("a").alias("a")).select("a", "b"), "near-tried").rows
    likely = stored(_sketched(tried, nodes, similarity), "near-pairs").rows
    links = stored(links.union(_confirmed(likely, nodes, source, n_words, similarity)), "near-links").rows
    label = connected_components(links).rows

    left = open_keys()
    tops = left.filter("node = a").select("key", F.col("label").alias("top"))
    stars = stored(
        left.filter("node != a").join(tops, "key").filter("label != top").select("a", F.col("node").alias("b")).distinct()
        .join(tried, ["a", "b"], "left_anti"), "near-tried").rows
    likely = stored(_sketched(stars, nodes, similarity), "near-pairs").rows
    links = stored(links.union(_confirmed(likely, nodes, source, n_words, similarity)), "near-links").rows
    label = connected_components(links).rows

    left = open_keys().filter("node != a").select("key", "node", "label")
    more = _all_met(left, nodes, source, n_words, similarity)
    met.drop()
    if not more.isEmpty():
        links = stored(links.union(more), "near-links").rows
        label = connected_components(links).rows
    members = nodes.select("node", "first").join(
        label.union(label.select("label", "label")).distinct(), "node")  # nodes of components of two and more only
    best = members.groupBy(F.col("label").alias("component")).agg(F.min("first").alias("best"))
    told = label.union(label.select("label", "label")).distinct().toDF("node", "component").join(best, "component")
    placed = nodes.select("same", "node", "first").join(told, "node", "left").select(
        "same", F.coalesce("component", "node").alias("component"), F.coalesce("best", "first").alias("best"))
    return rows.join(placed, "same").select(
        "h1", "h2", "component", ((F.col("h1") == F.col("best.h1")) & (F.col("h2") == F.col("best.h2"))).alias("stays"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of docs that stand for their component; repeated rows once."""
    found = near_copies(docs, doc_id, text, **how)
    gone = stored(found.filter("NOT stays").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).distinct(), "near-gone").rows
    h1, h2 = F.xxhash64(docs[doc_id], docs[text]), F.hash(docs[doc_id], docs[text])
    kept = docs.join(gone, (h1 == gone["_h1"]) & (h2 == gone["_h2"]), "left_anti")
    return kept.dropDuplicates([doc_id, text])
