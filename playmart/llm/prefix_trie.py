"""Prefix trie of conversations by the van Emde Boas recursion.

Positions lie in nested blocks of 2, 4, 8, ... turns. A block of length L that starts under the trie
node t is cut at half its depth: its first L/2 turns under t are the cut prefix, whose name is a
digest of t and of those turns, and which is where a tree of the lower forest starts. From the
longest block down, every round names the cuts of all blocks of one length at once; after the last
one a block is a single turn and its tree is that turn's parent node. Totals go the other way: from
the shortest block up, every round adds what the roots of the lower forests have gathered to all
nodes above them in their block's upper trie. A path of D turns takes log2(D) rounds each way, a round
handles (conversation, block) rows by composite keys, and no conversation or node is ever gathered.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import Stored, stored
from playmart.operators.ordered import ranked

# Ids joined into one string before the strings of a node meet; bounds the rows' size.
PIECE = 256


def _digest(*parts: Column) -> Column:
    """16 bytes of SHA-256: equal for equal parts only, so names need no dictionary."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), sym (digest of role and text) and chars (code points of the text).

    Turns go by turn (null first), then role, then text; a null role or text is empty, rows without a
    conv_id belong to no conversation and are left out. Repeated rows are turns of their own.
    """
    told = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    at = ranked(told, order, "at")
    turns = stored(at.select(
        "conv_id", "at", F.char_length("text").cast("long").alias("chars"),
        _digest(F.char_length("role").cast("string").cast("binary"), F.lit(":").cast("binary"), F.encode("role", "UTF-8"),
                F.encode("text", "UTF-8")).alias("sym")), "trie-turns").rows
    first = turns.groupBy("conv_id").agg(F.min("at").alias("first"))
    return turns.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("first")).alias("pos"), "sym", "chars")


def build_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences in `turns` (conv_id, pos from 0 without gaps, sym, chars).

    `convs` (conv_id, distinct) may name conversations without turns. Returns, all long but the last:
    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs, n_children, n_leaves and
    saved_tokens (over the subtree), ends_sha256. No conversation at all gives no rows.
    """
    paths, levels = _named(turns)
    drawn = stored(
        paths.rows.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.first("pos").alias("pos"), F.first("parent").alias("parent"),
            F.first("chars").alias("chars"), F.count("*").alias("n_convs")), "trie-drawn").rows
    fans = drawn.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = stored(
        drawn.join(fans, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "trie-nodes")
    totals = _grafted(nodes.rows, paths.rows, levels)
    ends = _ends(paths.rows, convs)
    tops = totals.join(nodes.rows.filter("pos = 0").select("node"), "node", "left_semi")
    none = F.lit(0).cast("long")
    root = convs.select("conv_id", F.lit(1).alias("n"), none.alias("kids"), none.alias("leaves"), none.alias("saved")).union(
        tops.select(F.lit(None), F.lit(0), F.lit(1), "leaves", "saved")
    ).agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("kids").alias("n_children"),
          F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).filter("n_convs > 0").select(
        F.lit(b"").alias("node"), "conv_id", none.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        "n_children", F.greatest("leaves", F.lit(1)).alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    up = nodes.rows.select("node", "conv_id").union(root.select("node", "conv_id")).toDF("parent", "parent_conv_id")
    rest = nodes.rows.join(totals, "node").join(up, "parent", "left").select(
        "node", "conv_id", (F.col("pos") + 1).alias("depth"), "parent_conv_id", "n_convs", "n_children",
        totals["leaves"].alias("n_leaves"), totals["saved"].alias("saved_tokens"))
    return root.union(rest).join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def _named(turns: DataFrame) -> tuple[Stored, int]:
    """Stored conv_id, pos, chars, parent, node; and the number of levels: blocks go up to 2**levels turns."""
    at = stored(turns, "trie-rebuilt")
    longest = at.rows.agg(F.max("pos") + 1).first()[0]
    levels = (longest or 0).bit_length()
    halves = [stored(at.rows.select("conv_id", F.col("pos").alias("b"), F.col("sym").alias("dg")), "trie-halves")]
    for _ in range(levels - 1):  # digests of whole blocks, each of the two of half its length
        two = halves[-1].rows.groupBy("conv_id", F.shiftright("b", 1).alias("b")).agg(
            F.min_by("dg", "b").alias("x"), F.max_by("dg", "b").alias("y"), F.count("*").alias("n")).filter("n = 2")
        halves.append(stored(two.select("conv_id", "b", _digest("x", "y").alias("dg")), "trie-halves"))
    trees = stored(at.rows.filter("pos = 0").select("conv_id", F.col("pos").alias("b"), F.lit(b"").alias("tree")), "trie-trees")
    lengths = at.rows.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"))
    long = stored(lengths, "trie-lengths")
    for k in range(levels, 0, -1):
        half = 1 << (k - 1)
        reach = long.rows.filter(F.col("n") >= half)
        cut = (
            trees.rows.withColumn("b", F.col("b") * 2)
            .join(halves[k - 1].rows, ["conv_id", "b"]).join(reach, "conv_id")
            .filter((F.col("b") + 1) * half <= F.col("n"))
            .select("conv_id", F.col("b") + 1, _digest("tree", "dg"))
        )
        new = stored(trees.rows.select("conv_id", F.col("b") * 2, "tree").union(cut).toDF("conv_id", "b", "tree"), "trie-trees")
        trees.drop()
        halves.pop().drop() if k > 1 else None
        trees = new
    # the tree that starts at a turn is its parent node, the tree that would start after it is the turn's own node
    paths = stored(
        at.rows.select("conv_id", "pos", "chars")
        .join(trees.rows.select("conv_id", F.col("b").alias("pos"), F.col("tree").alias("parent")), ["conv_id", "pos"])
        .join(trees.rows.select("conv_id", (F.col("b") - 1).alias("pos"), F.col("tree").alias("node")), ["conv_id", "pos"]), "trie-paths")
    for done in (trees, long, *halves, at):
        done.drop()
    return paths, levels


def _grafted(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """node, leaves, saved: sums over subtrees, each with its top."""
    own = nodes.select("node", "leaves", "saved")
    kept = own
    for k in range(1, levels + 1):
        half = 1 << (k - 1)
        tops = nodes.filter(F.col("pos") % (2 * half) == half).select("node", "conv_id", F.shiftright("pos", k).alias("block"))
        gathered = kept.join(tops.select("node"), "node", "left_semi").groupBy("node").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        above = paths.filter(F.col("pos") % (2 * half) < half).select(
            "conv_id", F.shiftright("pos", k).alias("block"), F.col("node").alias("upper"))
        more = (
            tops.join(gathered, "node").join(above, ["conv_id", "block"])
            .groupBy(F.col("upper").alias("node")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        )
        kept = kept.union(stored(more, "trie-grafts").rows)
    return stored(kept.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "trie-totals").rows


def _ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """node, ends_sha256 of the nodes where conversations end.

    Ids are joined in sorted ranges, in pieces; then the pieces of a node, in order, pass through one
    hash, of which a task holds nothing but the state.
    """
    last = paths.groupBy("conv_id").agg(F.max_by("node", "pos").alias("node"))
    ended = stored(convs.join(last, "conv_id", "left").select(F.coalesce("node", F.lit(b"")).alias("node"), "conv_id"), "trie-ends").rows

    def pieces(batches):
        node, first, ids, out = None, None, [], []

        def flush():
            if ids:
                out.append((node, first, ",".join(map(str, ids))))

        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n != node or len(ids) >= PIECE:
                    flush()
                    node, first, ids = n, c, []
                ids.append(c)
            yield _batch(out, ("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string()))
            out = []
        flush()
        yield _batch(out, ("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string()))

    def hashes(batches):
        node, state, out = None, None, []
        for batch in batches:
            for n, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if n != node:
                    if state:
                        out.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(s.encode())
            yield _batch(out, ("node", pa.binary()), ("ends_sha256", pa.string()))
            out = []
        if state:
            yield _batch([(node, state.hexdigest())], ("node", pa.binary()), ("ends_sha256", pa.string()))

    joined = ended.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        pieces, "node binary, first long, ids string")
    return joined.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashes, "node binary, ends_sha256 string")


def _batch(rows: list[tuple], *fields: tuple[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def rebuilt_turns(conversations: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, convs): every conversation c with its first h turns taken from conversation c - c % group.

    h is crc32(decimal c) % heads. c keeps its own turns after its first h; where the other has fewer
    than h turns, or is absent, that many fewer are taken.
    """
    turns = stored(numbered_turns(conversations), "trie-numbered").rows
    sizes = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumns({
        "h": F.crc32(F.col("conv_id").cast("string")) % heads, "root": F.col("conv_id") - F.col("conv_id") % group}), "trie-sizes").rows
    roots = sizes.select(F.col("conv_id").alias("root"), F.col("n").alias("root_n"))
    plan = stored(sizes.join(roots, "root", "left").select(
        "conv_id", "root", "h", F.least("h", F.coalesce("root_n", F.lit(0))).alias("taken")), "trie-plan").rows
    own = turns.join(plan, "conv_id").filter("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "sym", "chars")
    head = turns.filter((F.col("pos") < heads - 1) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "root")
    lent = plan.join(head, "root").filter("pos < taken").select("conv_id", "pos", "sym", "chars")
    return own.union(lent), sizes.select("conv_id")
