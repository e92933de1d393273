from __future__ import annotations

import os

from pyspark.sql import functions as F

from playmart.llm import common


def test_stored_tables_last_until_they_are_cleared(spark, docs):
    made = common.stored(docs([(1, "a")]).select("doc_id"), "kept")
    assert made.rows.count() == 1
    path = made.path.removeprefix("file:")
    assert os.path.isdir(path)
    common.clear_scratch(spark)
    assert not os.path.exists(path)
    common.clear_scratch(spark)


def test_a_counted_side_is_broadcast_only_when_small(docs, monkeypatch):
    left, right = docs([(1, "a"), (2, "b")]).select("doc_id"), docs([(2, "x")]).select("doc_id", "text")
    small = common.join_counted(left, right, "doc_id", "left", 1)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    large = common.join_counted(left, right, "doc_id", "left", 1)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert hinted(small) and not hinted(large)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect())) == [(1, None), (2, "x")]


def test_rows_pass_through_whole(docs, nothing):
    def make():
        return lambda texts: [[len(t or "") for t in texts.to_pylist()]]

    frame = docs([(1, "abc"), (None, None)])
    out = common.annotate(frame, [F.col("text")], make, "row_length long")
    assert out.select("row.*").collect() == frame.collect()
    assert [r.row_length for r in out.collect()] == [3, 0]
    assert common.annotate(nothing, [F.col("text")], make, "row_length long").count() == 0
