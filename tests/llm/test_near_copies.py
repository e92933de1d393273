from __future__ import annotations

import random

import numpy as np

from playmart.llm import near_copies, simhash


def plain_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_stays(rows):
    """Smallest id of everything joined by pairs of similarity 0.8, by comparing all pairs."""
    sets, label = [plain_set(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    groups = {}
    for k, (i, _) in zip(label, rows, strict=True):
        groups.setdefault(k, []).append(i)
    return sorted(min(g) for g in groups.values())


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.randrange(10**6)}"
    return out


def corpus():
    """Copies around the bar, chains of copies, and texts that only share a long passage."""
    rng = random.Random(7)
    fresh = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    shared, texts = fresh(60), []
    for i in range(12):
        words = fresh(rng.choice((40, 200)))
        texts.append(words)
        for _ in range(5):
            texts.append(edited(rng, words if i % 2 else texts[-1], rng.randint(0, 7)))
    texts += [shared + fresh(rng.choice((5, 20, 60))) for _ in range(15)] + [fresh(n) for n in (1, 3, 5, 6)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_the_pipeline_keeps_one_of_each_group_of_copies(spark, docs):
    import corpus_pipeline

    rows = corpus()
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    got = sorted(r.doc_id for r in stage(spark, docs(rows), "").collect())
    assert got == plain_stays(rows) and 20 < len(got) < len(rows) - 20


def test_pairs_are_compared_beyond_the_first_of_a_key(docs, monkeypatch):
    """All rows meet in one key, whose first row is unlike the others."""
    bands = near_copies.bands
    monkeypatch.setattr(near_copies, "bands", lambda found: (np.zeros(1, np.int64), bands(found)[1]))
    rows = corpus()[:40]
    got = sorted(r.doc_id for r in near_copies.keep_one_of_each(docs(rows)).collect())
    assert got == plain_stays(rows)


def test_texts_just_below_the_bar_do_not_make_their_pairs_rows(docs, monkeypatch):
    """One key holds many texts that are alike without being copies, and some copies; it is dealt into blocks."""
    bands, stored, made = near_copies.bands, near_copies.stored, {}

    def counted(df, name, *how):
        held = stored(df, name, *how)
        made[name] = max(made.get(name, 0), held.rows.count())
        return held

    monkeypatch.setattr(near_copies, "bands", lambda found: (np.zeros(1, np.int64), bands(found)[1]))
    monkeypatch.setattr(near_copies, "fingerprint", lambda t: near_copies.xxhash.xxh64_intdigest(t))  # SimHash links none
    monkeypatch.setattr(near_copies, "stored", counted)
    monkeypatch.setattr(near_copies, "HELD", 20, raising=False)
    rng = random.Random(3)
    base = [f"w{rng.randrange(4000)}" for _ in range(80)]
    texts = [[f"z{i}" for i in range(80)]] + [base[:70] + [f"t{i}x{k}" for k in range(10)] for i in range(70)]
    texts += [[*t[:-1], "end"] for t in texts[5::10]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = sorted(r.doc_id for r in near_copies.keep_one_of_each(docs(rows)).collect())
    assert got == plain_stays(rows) == list(range(71))
    assert max(made.values()) <= 2 * len(rows) and made["near-blocks"] == 1


def test_links_of_a_key_are_a_forest():
    """Rows in batches that cut blocks apart, against all pairs."""
    rng = random.Random(5)
    texts = [" ".join(t) for _, t in ((0, edited(rng, [f"w{i}" for i in range(90)], rng.randint(0, 4))) for _ in range(60))]
    found = [near_copies.shingles(t) for t in texts]
    made = [near_copies.bands(f) for f in found]
    side = lambda at: near_copies._Texts(
        np.array(at), np.array(at), np.array([len(found[i]) for i in at]), np.array([made[i][1] for i in at]).view(np.uint64),
        np.zeros((len(at), 1), np.int64), [found[i] for i in at])
    x, y = side(range(25)), side(range(25, 60))
    links = [near_copies._forest(*pair, 0, 0.8) for pair in ((x, x), (x, y), (y, y))]
    pairs = [(int(a), int(b)) for part in links for c in part for a, b in zip(*c, strict=True)]
    assert all(near_copies.jaccard(found[a], found[b]) >= 0.8 for a, b in pairs) and len(pairs) < 60
    label = list(range(60))
    for a, b in pairs:
        label = [min(label[a], label[b]) if v in (label[a], label[b]) else v for v in label]
    assert sorted(set(label)) == plain_stays(list(enumerate(texts))) and 1 < len(set(label)) < 50


def test_bands_propose_pairs_of_the_least_similarity():
    rng = np.random.default_rng(5)
    for _ in range(300):
        all_of = rng.integers(0, 1 << 63, 100, np.uint64)
        a, b = np.unique(all_of[:90]), np.unique(all_of[10:])
        (keys, bits), (other, others) = near_copies.bands(a), near_copies.bands(b)
        assert near_copies.jaccard(a, b) == 0.8 and (keys == other).any()
        assert np.bitwise_count((bits ^ others).view(np.uint64)).sum() <= near_copies.DIFFER


def test_fingerprints_drop_unlike_pairs():
    rng = np.random.default_rng(6)
    dropped = 0
    for _ in range(100):
        all_of = rng.integers(0, 1 << 63, 160, np.uint64)
        (_, bits), (_, others) = near_copies.bands(np.unique(all_of[:100])), near_copies.bands(np.unique(all_of[60:]))  # 0.25 alike
        dropped += np.bitwise_count((bits ^ others).view(np.uint64)).sum() > near_copies.DIFFER
    assert dropped > 95


def test_one_id_with_two_texts_and_rows_without_an_id(docs):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, b), (5, a), (5, b), (9, a + " tail"), (None, a + " end"), (None, "quite another text of some words"), (None, "quite another text of some words")]
    got = near_copies.keep_one_of_each(docs(rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, rows[5][1]), (1, b), (5, a)]


def test_odd_documents(odd, nothing):
    kept = near_copies.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 6, 7] and ids.count(None) == 1
    assert near_copies.keep_one_of_each(nothing).count() == 0


def test_fingerprints_link_what_shingles_leave_apart(docs):
    """A pair within SimHash's three bits whose similarity is below the bar, in chains over a smaller id."""
    rng = random.Random(11)
    bits = lambda a, b: (simhash.fingerprint(" ".join(a)) ^ simhash.fingerprint(" ".join(b))).bit_count()
    rows = []
    while len(rows) < 6:
        words = [f"w{rng.randrange(4000)}" for _ in range(24)]
        other = edited(rng, words, 1)
        if bits(words, other) <= 3 and near_copies.jaccard(*(near_copies.shingles(" ".join(x)) for x in (words, other))) < 0.8:
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    assert sorted(r.doc_id for r in near_copies.keep_one_of_each(docs(rows)).collect()) == [0, 2, 4]
