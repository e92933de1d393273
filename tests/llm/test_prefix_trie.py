from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from playmart.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, pos long, parent string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[: heads[c]] + v[heads[c] :] for c, v in own.items()}


def plain_trie(seqs):
    members, kids, below = defaultdict(list), defaultdict(list), {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    for n in sorted(members, key=len, reverse=True):
        saved = (len(members[n]) - 1) * len(n[-1][1]) if n else 0
        below[n] = (sum(below[k][0] for k in kids[n]) or 1, saved + sum(below[k][1] for k in kids[n]))
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(kids[n]), *below[n],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(n)))).encode()).hexdigest())
        for n, m in members.items())


def trie(spark, rows):
    given = spark.createDataFrame([(*r, "own", 7, "own") for r in rows], SCHEMA)
    got = prefix_trie.build_trie(*prefix_trie.rebuilt_turns(given)).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in got)


def chats(seed):
    """Few distinct turns, so that paths branch everywhere; ties, nulls, one long path, missing roots."""
    rng = random.Random(seed)
    rows = [(c, t, rng.choice("ua"), rng.choice(["", "x", "yé", None])) for c in range(150, 420) for t in range(rng.choice((1, 2, 3, 9)))]
    rows += [(507, t, "u", "long") for t in range(45)] + [(c, t, "u", "long") for c in (500, 508) for t in range(33)]
    rows += [(900, None, None, None), (900, None, "u", "b"), (900, 3, "u", "b"), (900, 3, "u", "b"), (None, 1, "u", "x")]
    return rows + [(700 + i, 0, "u", "only") for i in range(40)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_trie(spark, seed):
    rows = chats(seed)
    assert trie(spark, rows) == plain_trie(rebuilt(rows))


def test_ids_of_one_node_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, t, "u", "same") for c in range(100, 200) for t in range(6)]
    assert trie(spark, rows) == plain_trie(rebuilt(rows))


def test_long_text_and_role_borders(spark):
    rows = [(100, 0, "u", "x" * 200_000), (200, 0, "ux", "x" * 199_999), (300, 0, "", ""), (400, 0, None, None)]
    assert trie(spark, rows) == plain_trie(rebuilt(rows))


def test_no_conversation(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "u", "x")]) == []
