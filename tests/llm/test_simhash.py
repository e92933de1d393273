from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from playmart.llm import simhash
from playmart.llm.components import connected_components


def plain_fingerprint(text, k=3):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(points, budget):
    """Smallest node reachable, by comparing all pairs."""
    label = {n: n for n, _ in points}
    moved = True
    while moved:
        moved = False
        for a, x in points:
            for b, y in points:
                if label[b] > label[a] and bin(x ^ y).count("1") <= budget:
                    label[b] = label[a]
                    moved = True
    return label


@pytest.mark.parametrize("text", [None, "", " \n", "One", "A b", "a b c", "Ü A\x0bb a b c a b c", "x" * 1000, "\x1c a\x85b c d"])
def test_fingerprint_follows_its_rule(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def clustered(n, seed):
    """Random fingerprints and chains of neighbours a few bits away."""
    rng = random.Random(seed)
    found = set()
    while len(found) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice((1, 1, 3, 12))):
            found.add(x)
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
    return [(i, x) for i, x in enumerate(sorted(found, key=lambda v: v * 0x9E3779B97F4A7C15 % 2**64)[:n])]


@pytest.mark.parametrize("block", [2048, 3])
@pytest.mark.parametrize(("budget", "segments"), [(3, 4), (1, 4), (4, 8)])
def test_groups_equal_all_pairs(spark, monkeypatch, budget, segments, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    points = clustered(260, budget * 7 + segments)
    df = spark.createDataFrame([(n, int(np.uint64(x).astype(np.int64))) for n, x in points], "node long, fp long")
    labels = connected_components(simhash.pigeonring_edges(df, budget, segments)).rows.collect()
    got = {n: n for n, _ in points} | {r.node: r.label for r in labels}
    assert got == plain_groups(points, budget)


def test_a_dense_group_leaves_as_a_forest(spark):
    """Every pair of these is linked, but edges are no more than rows filed."""
    points = [(i, int(np.uint64(1 << i).astype(np.int64))) for i in range(64)]
    edges = simhash.pigeonring_edges(spark.createDataFrame(points, "node long, fp long"))
    assert edges.count() <= 64 * 72
    assert {r.label for r in connected_components(edges).rows.collect()} == {0}


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).rows.collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 200: 199}


def test_odd_documents(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.fingerprint, r.component_id))
    assert by[1] == by[2] == by[3] == [("0" * 16, 1)]  # without words: zero, linked like any other
    assert by[4] == [by[8][0]] * 2 and by[8][0][1] == 4
    assert all(c is None for _, c in by[None])
    assert simhash.near_duplicates(nothing).collect() == []


def test_one_document_of_each_group_stays(docs, odd):
    kept = simhash.keep_one_of_each(docs([(3, "a b c d"), (1, "A  b c d"), (2, "other words here now"), (2, "other words here now")]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert kept.columns[:2] == ["doc_id", "text"] and {r.fp for r in kept.collect()} == {"own"}
    ids = [r.doc_id for r in simhash.keep_one_of_each(odd).collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 6, 7] and ids.count(None) == 2
