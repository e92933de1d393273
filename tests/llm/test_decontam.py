from __future__ import annotations

import random

from playmart.llm import decontam as d


def sellers(pattern, text):
    """(least distance, first end) by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row), row.index(min(row))


def test_myers_equals_dynamic_programming():
    rng = random.Random(4)
    for _ in range(300):
        p = [rng.randint(1, 5) for _ in range(rng.randint(1, 80))]
        t = [rng.randint(1, 5) for _ in range(rng.randint(1, 90))]
        distance, end = sellers(p, t)
        found = d.best_occurrence(p, t, len(p))
        assert found[0] == distance and (found[1] == end or end == 0)
        assert d.best_occurrence(p, t, distance - 1) is None


def test_every_item_within_its_budget_is_found():
    """Planted with random edits; what plain search over the whole text finds must be found."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(3, 40)))) for i in range(30)]
    index = d.Index.of(items, d.SIMILARITY)
    keys = index.keys()
    for _ in range(60):
        item, text = rng.choice(items)
        words = text.split()
        for _ in range(rng.randint(0, len(words) // 4)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice(([], ["new"], [words[at], "more"]))
        body = " ".join(rng.choices(vocabulary, k=40) + words + rng.choices(vocabulary, k=40))
        found = {h[0]: h[1] for h in d.occurrences(body, index, keys)}
        for i, t in items:
            distance, _ = sellers(t.split(), body.split())
            assert found.get(i) == (distance if distance <= d.errors(len(t.split())) else None)


def test_odd_documents_and_benchmarks(spark, docs, odd, nothing):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, "word word word word word word"), (5, "The QUICK_brown fox"), (None, "x")], "item_id long, text string")
    got = {r.doc_id: r.leaks for r in d.find_leaks(odd, bench).select("row.doc_id", "leaks").collect()}
    assert [x.item_id for x in got[6]] == [4] and all(not v for k, v in got.items() if k != 6)
    assert d.find_leaks(nothing, bench).count() == 0
    assert all(not r.leaks for r in d.find_leaks(odd, bench.limit(0)).collect())
    frame = docs([(1, "say: the quick brown fox!"), (2, "the slow fox"), (3, None)])
    kept = d.without_leaks(frame, bench)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_passes_over_a_large_benchmark_add_up(spark, docs):
    bench = spark.createDataFrame([(i, f"alpha{i} beta{i} gamma{i} delta{i}") for i in range(40)], "item_id long, text string")
    frame = docs([(k, " ".join(f"alpha{i} beta{i} gamma{i} delta{i}" for i in range(k, k + 3))) for k in range(30)])
    one = d.find_leaks(frame, bench).select("row.doc_id", "leaks").collect()
    many = d.find_leaks(frame, bench, per_pass=40).select("row.doc_id", "leaks").collect()
    assert sorted(map(repr, one)) == sorted(map(repr, many)) and all(len(r.leaks) == 3 for r in one)


def test_items_without_an_id_count(spark, docs):
    a, b, c = "alpha beta gamma delta epsilon zeta", "one two three four five six seven", "red green blue white black grey"
    rows = docs([(1, f"so {a} it is"), (2, f"{c} and {b} and {a}"), (3, "nothing of the kind here")])
    bench = spark.createDataFrame([(None, a), (None, b), (7, c), (None, None)], "item_id long, text string")
    for per_pass in (d.WORDS_PER_PASS, 2):
        got = {r.row.doc_id: [(x.item_id, x.first_word) for x in r.leaks] for r in d.find_leaks(rows, bench, per_pass=per_pass).collect()}
        assert got[1] == [(None, 1)] and got[3] == []
        assert sorted(got[2], key=lambda x: x[1]) == [(7, 0), (None, 7), (None, 15)]
    assert [r.doc_id for r in d.without_leaks(rows, bench).collect()] == [3]
