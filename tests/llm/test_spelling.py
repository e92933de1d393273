from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from playmart.llm import spelling


def one_edit(a, b):
    """Exactly one code point put in, left out or replaced, by trying all places."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts, times=5):
    out = []
    forms = {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        forms[w] = form
        out.append([w, n, len(near), form, counts[form] if form else None])
    for row in out:
        root = row[0]
        while forms[root]:
            root = forms[root]
        row.append(root)
    return sorted(map(tuple, out))


def vocabulary(n, seed, letters="abcé"):
    """Words over few letters with many neighbours, some only one code point from a neighbour's neighbour."""
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.choice((1, 2, 6, 7, 9, 14))))
        for _ in range(rng.choice((1, 2, 5))):
            words.add(w)
            i = rng.randrange(len(w) + 1)
            w = w[:i] + rng.choice((rng.choice(letters), "")) + w[i + rng.choice((0, 1)) :] or w
    return {w: rng.choice((1, 5, 5, 26, 140, 800)) for w in sorted(words)}


@pytest.mark.parametrize(("least", "seed"), [(20, 1), (0, 3)])
def test_groups_equal_all_pairs(spark, monkeypatch, least, seed):
    monkeypatch.setattr(spelling, "LEAST_FREQUENT", least)
    counts = vocabulary(300, seed)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [tuple(r) for r in spelling.variant_groups(words).select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert sorted(got) == plain_groups(counts)


@pytest.mark.parametrize("seed", range(3))
def test_an_edit_leaves_all_but_the_affected_grams(seed):
    rng = random.Random(seed)
    frequent = {"".join(rng.choice("ab\x02\x03") for _ in range(rng.randint(2, spelling.QMAX - 1))) for _ in range(60)}
    grams = spelling.Grams(frequent)

    def cut(word):
        w = spelling.START + word + spelling.END
        return w, grams.spans(w)

    for _ in range(600):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        w, spans = cut(word)
        mine, most = Counter(w[p:e] for p, e in spans), grams.affected(w, spans)
        i = rng.randrange(len(word) + 1)
        for other in (word[:i] + rng.choice("abc") + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice("abc") + word[i + 1 :]):
            v, found = cut(other)
            assert sum((mine & Counter(v[p:e] for p, e in found)).values()) >= len(spans) - most


def test_the_dictionary_has_a_bound(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LEAST_FREQUENT", 1)
    words = spark.createDataFrame([(w, 5) for w in vocabulary(300, 5)], "word string, n long")
    assert len(spelling.frequent_pieces(words)) > 60
    monkeypatch.setattr(spelling, "DICTIONARY", 60)
    assert 0 < len(spelling.frequent_pieces(words)) <= 60


def test_counts_of_altered_runs(docs, odd, nothing, monkeypatch):
    monkeypatch.setattr(spelling, "FLUSH", 3)
    texts = [(i, f"Éclairs ÉCLAIRS? house{i}keeper×wörter " + "Gardens, " * (i % 3)) for i in range(40)] + [(None, "gardens"), (7, None)]
    want = Counter()
    for i, t in texts:
        for run in spelling.RUN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run if h % 9 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    got = spelling.word_counts(docs(texts), least_count=1, alter=lambda i, run: spelling.drop_one(i, run, 9))
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in want.items() if len(w) >= 6}
    assert spelling.word_counts(odd).collect() == []
    assert spelling.variant_groups(spelling.word_counts(nothing)).collect() == []


def test_long_words(spark):
    long = "ab" * 3000
    counts = {long: 5, long[:2500] + long[2501:]: 100, long + "a": 5, "single": 9}
    got = spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert sorted(tuple(r) for r in got.select("word", "n", "n_near", "form", "form_n", "root").collect()) == plain_groups(counts)
    assert got.filter(F.col("n_near") > 0).count() == 3
