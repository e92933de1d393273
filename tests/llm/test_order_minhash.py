from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from playmart.llm import order_minhash as o

ALL = (1 << 64) - 1


def mixed(x):
    x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & ALL
    x = ((x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53) & ALL
    return x ^ (x >> 33)


def plain(text, k=o.K, slots=o.SLOTS, many=o.TUPLE):
    out, seen, filed = [0] * slots, {}, {}
    for i in range(max(1, len(text) - k + 1) if text else 0):
        h = 0
        for c in text[i : i + k]:
            h = (h * 0x9E3779B97F4A7C15 + ord(c)) & ALL
        h = mixed(h)
        seen[h] = seen.get(h, 0) + 1
        g = mixed((h + seen[h] * 0x9E3779B97F4A7C15) & ALL)
        filed.setdefault((g >> 32) % slots, []).append((g >> 7, i, h))
    for slot, found in filed.items():
        v = 0
        for r, (_, _, h) in enumerate(sorted(sorted(found)[:many], key=lambda x: x[1])):
            v = mixed((v * 0x9E3779B97F4A7C15 + h + r + 1) & ALL)
        out[slot] = v % 65535 + 1
    return out


@pytest.mark.parametrize("n", [0, 1, 3, 8, 9, 60, 700, 5000])
@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh é世"])
def test_fingerprint_follows_its_rule(n, letters):
    rng = random.Random(n)
    text = "".join(rng.choice(letters) for _ in range(n))
    assert o.fingerprint(text).tolist() == plain(text)


def test_order_matters_and_likeness_falls_with_edits():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    text = " ".join(words)
    near = [o.likeness(o.fingerprint(text), o.fingerprint(" ".join(words[:k] + words[400 - k :][::-1]))) for k in (400, 380, 300, 200)]
    blocks = " ".join(words[200:] + words[:200])
    assert o.likeness(o.fingerprint(text), o.fingerprint(text)) == 1 > near[1] > near[2] > near[3]
    assert o.likeness(o.fingerprint(text), o.fingerprint(blocks)) < 0.9  # the same k-mers, in another order
    assert o.likeness(o.fingerprint(""), o.fingerprint(None)) == 1 and o.likeness(o.fingerprint(""), o.fingerprint(text)) == 0


@pytest.mark.parametrize("range_rows", [4000, 5])
def test_each_document_meets_the_next(docs, range_rows):
    rng = random.Random(2)
    rows = [(i * 3 - 20, "".join(rng.choices("abc é", k=rng.choice((0, 1, 5, 80))))) for i in range(40)]
    shuffled = rng.sample(rows, len(rows))
    got = {r.doc_id: r for r in o.fingerprints(docs(shuffled), range_rows=range_rows).collect()}
    assert len(got) == len(rows)
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = map(o.fingerprint, (text, changed, following))
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert got[i].fingerprint == o._hex(a) and got[i].edited_fingerprint == o._hex(b)
        assert got[i].near_edited == o.likeness(a, b) and got[i].near_next == o.likeness(a, c)


def test_odd_documents(odd, nothing, docs):
    rows = o.fingerprints(odd, range_rows=2).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in rows) == sorted(
        (r.doc_id is None, r.doc_id or 0, len(r.text or "")) for r in odd.collect())
    assert o.fingerprints(nothing).collect() == []
    alone = o.fingerprints(docs([(9, "abcdef")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and alone.near_next == 1
    assert np.array_equal(o.fingerprint("same text"), o.fingerprint("same text"))
