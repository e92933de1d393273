from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from playmart.llm import ordinal_quality as q


def rated(n, seed=1):
    """Grade 0 texts hold a bad word, grade 2 texts a good one."""
    rng = np.random.default_rng(seed)
    common = [f"word{i}" for i in range(200)]
    out = []
    for i in range(n):
        grade = i % 3
        words = [*rng.choice(common, 40), *(["awful"] * (grade == 0)), *(["splendid"] * (grade == 2))]
        rng.shuffle(words)
        out.append((" ".join(words), grade))
    return out


def test_held_out_grades_and_ordered_tails(docs):
    model = q.train(rated(600), 3)
    assert (np.diff(model.thresholds) > 0).all()
    test = rated(120, seed=5)
    got = q.rate(docs([(i, t) for i, (t, _) in enumerate(test)]), model).select("row.doc_id", "expected_grade", "tails", "grade", "keep").collect()
    right = [r.grade == test[r.doc_id][1] for r in got]
    assert np.mean(right) > 0.95
    for r in got:
        assert 1 >= r.tails[0] >= r.tails[1] >= 0 and abs(sum(r.tails) - r.expected_grade) < 1e-9
        assert r.keep == (test[r.doc_id][1] > 0)


def test_fit_joins_ratings_and_leaves_odd_ones_out(spark, docs):
    texts = rated(300)
    ratings = spark.createDataFrame([(i, g) for i, (_, g) in enumerate(texts)] + [(0, None), (1, 9), (None, 1), (10_000, 2)], "doc_id long, g int")
    model = q.fit(docs([(i, t) for i, (t, _) in enumerate(texts)]), ratings, F.col("g"), 3)
    assert q.score(q.features("a splendid thing", model.settings), model) > q.score(q.features("an awful thing", model.settings), model)


def test_odd_documents(odd, nothing):
    model = q.train(rated(60), 3)
    rows = q.rate(odd, model).select("row.score", "expected_grade", "grade").collect()
    assert len(rows) == odd.count() and all(np.isfinite(r.expected_grade) and r.score == 0.5 for r in rows)
    assert q.rate(nothing, model).count() == 0
    blank = q.train([], 3)
    assert len({r.expected_grade for r in q.rate(odd, blank).collect()}) == 1
    assert q.rate(odd, q.train([("only", 1)] * 5, 3)).count() == odd.count()
