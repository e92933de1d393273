"""Ordered operators against plain windows, with a key that owns most of the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmart.operators.ordered import keep_first, ranked, split_scan, top_per_group
from playmart.operators.sets import is_subset, lump_rest, missing_keys, pair_overlaps, with_share
from playmart.operators.versions import overlapping_versions, version_starts, with_epoch


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows, over forty days."""
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 != 0, "hot").otherwise(F.concat(F.lit("k"), n % 7)).alias("key"),
        F.timestamp_seconds(n * 1153 % 3_456_000).alias("at"), n.alias("seq"),
        F.when(n % 5 != 0, (n * 7919) % 101).alias("value"), (n % 3).alias("state"),
    )


def test_split_scan_equals_plain_windows(skewed):
    order = ["at", "seq"]
    got = split_scan(
        skewed, ["key"], order, F.to_date("at"), lag={"before": "value"}, lead={"after": "value"},
        running_sum={"total": "value"}, max_before={"top": "value"}, row_number="n",
    )
    w = Window.partitionBy("key").orderBy(*order)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns(
        {
            "before": F.lag("value").over(w), "after": F.lead("value").over(w),
            "total": F.sum("value").over(upto), "top": F.max("value").over(earlier),
            "n": F.row_number().over(w).cast("bigint"),
        }
    ).select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_split_scan_never_windows_a_whole_key(skewed):
    plan = split_scan(skewed, ["key"], ["at", "seq"], F.to_date("at"), lag={"b": "value"})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    over_rows = [line for line in text.splitlines() if "Window [" in line and "lag(value" in line]
    assert over_rows and all(line.count("__chunk") for line in over_rows)


def test_ranked_equals_global_row_number(skewed):
    nulls = skewed.withColumn("seen", F.when(F.col("seq") % 3 == 0, F.col("at")))
    order = [F.asc_nulls_last("seen"), F.asc("seq")]
    got = ranked(nulls, order, "rank", running_sum={"total": "value"}, slots=5)
    w = Window.orderBy(*order)
    want = nulls.withColumns(
        {"rank": F.row_number().over(w).cast("bigint"),
         "total": F.coalesce(F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))}
    ).select(*got.columns)
    assert got.count() == 3000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_keep_first_limits_groups_before_the_shuffle(skewed):
    one = keep_first(skewed, ["key"], [F.desc_nulls_last("value"), F.asc("seq")])
    assert one.count() == skewed.select("key").distinct().count()
    assert "WindowGroupLimit" in one._jdf.queryExecution().executedPlan().toString()


def test_top_per_group(skewed):
    top = top_per_group(skewed, ["key"], [F.desc_nulls_last("value"), F.asc("seq")], 3)
    assert top.groupBy("key").count().filter("count <> 3").isEmpty()


def test_versions_do_not_depend_on_row_order(skewed):
    spans = [
        with_epoch(
            version_starts(df, "key", ["at", "seq"], "state", F.to_date("at")), "1960-01-01"
        ).select("key", "version_number", "seq", "valid_from", "valid_to", "is_current")
        for df in (skewed, skewed.repartition(7, F.rand(3)))
    ]
    assert spans[0].exceptAll(spans[1]).isEmpty() and spans[0].count() == spans[1].count()
    current = spans[0].groupBy("key").agg(F.count_if("is_current").alias("n"))
    assert current.filter("n <> 1").isEmpty()
    assert overlapping_versions(
        spans[0], "key", F.to_date("valid_from")
    ).isEmpty()


def test_overlaps_are_found(rows):
    spans = rows(
        [("a", "2024-01-01", "2024-02-01"), ("a", "2024-01-15", None), ("b", "2024-01-01", None)],
        "key string, valid_from timestamp, valid_to timestamp",
    )
    bad = overlapping_versions(spans, "key", F.trunc("valid_from", "year")).collect()
    assert [(r["key"], r["valid_from"].day) for r in bad] == [("a", 15)]


def test_shares_and_lumping(rows):
    df = rows([("g", "a", 6), ("g", "b", 3), ("g", "c", 1), ("h", "a", 0)], "g string, v string, n int")
    got = {(r["g"], r["v"]): r["s"] for r in with_share(df, "n", ["g"], "s").collect()}
    assert got == {("g", "a"): 60.0, ("g", "b"): 30.0, ("g", "c"): 10.0, ("h", "a"): None}
    plain = rows([("g", v) for v in "aaabbc"], "g string, v string")
    lumped = lump_rest(plain, F.col("v"), ["g"], 2, "top").groupBy("top").count().collect()
    assert {r["top"]: r["count"] for r in lumped} == {"a": 3, "b": 2, "other": 1}


def test_lumping_keeps_null_and_takes_counts(rows):
    counts = rows([(None, "x", 5), (None, None, 9), ("g", None, 1), ("g", "a", 4), ("g", "b", 3)], "g string, v string, n int")
    lumped = lump_rest(counts, F.col("v"), ["g"], 1, "top", weight="n").groupBy("g", "top").agg(F.sum("n")).collect()
    assert sorted(map(repr, ((r[0], r[1], r[2]) for r in lumped))) == sorted(map(repr, [(None, None, 9), (None, "other", 5), ("g", "a", 4), ("g", "other", 4)]))


def test_key_sets(rows):
    left, right = rows([(1,), (2,), (2,), (3,)], "k int"), rows([(2,)], "k int")
    assert sorted(r["k"] for r in missing_keys(left, right, ["k"]).collect()) == [1, 3]
    assert is_subset(right, left, ["k"]).first()["is_subset"]
    assert is_subset(left, right, ["k"]).first()["outside"] == 2


def test_pair_overlaps_only_forms_asked_pairs(rows):
    members = rows(
        [("x", 1), ("x", 2), ("x", 2), ("y", 2), ("y", 3), ("z", None), ("z", 9)], "who string, k int"
    )
    pairs = rows([("x", "y"), ("x", "z")], "left_id string, right_id string")
    got = {r["right_id"]: (r["left_size"], r["right_size"], r["overlap"])
           for r in pair_overlaps(members, "who", ["k"], pairs).collect()}
    assert got == {"y": (2, 2, 1), "z": (2, 1, 0)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_history_equals_the_rebuild(spark, rows, tmp_path, seed):
    """Any split of the observations, in any order of arrival, some of them twice."""
    import random

    from playmart.operators.version_store import VersionStore

    rng = random.Random(seed)
    obs = [(f"k{rng.randrange(4)}", f"2024-{rng.randint(1, 5):02d}-{rng.randint(1, 28):02d} 10:00:00", n, rng.choice("AAB") if n % 9 else None)
           for n in range(120)]
    ddl = "k string, seen timestamp, id bigint, sig string"
    whole = rows(obs, ddl)
    store = VersionStore(spark, str(tmp_path), whole.schema, "k", ["seen", "id"], "sig")
    rng.shuffle(obs)
    shares = [obs[:10], obs[10:70], obs[60:80], obs[80:]]
    table, columns = None, ["k", "seen", "id", "sig", "valid_from", "valid_to", "version_number"]
    for n, share in enumerate(shares):
        new = rows(share, ddl)
        store.merge(new, n)
        if table is None:
            table = store.versions(n)
        else:
            table = store.refreshed(table, new.select("k").distinct(), n)
        table = spark.createDataFrame(table.collect(), table.schema)
    want = version_starts(whole, "k", ["seen", "id"], "sig", F.trunc("seen", "month"))
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, table.select(*columns).collect()), key=key) == sorted(map(tuple, want.select(*columns).collect()), key=key)
    assert sorted(map(tuple, store.versions(3).select(*columns).collect()), key=key) == sorted(map(tuple, want.select(*columns).collect()), key=key)


def test_a_merge_reads_and_writes_touched_months_only(spark, rows, tmp_path):
    from playmart.operators.version_store import VersionStore

    ddl = "k string, seen timestamp, id bigint, sig string"
    first = rows([("a", f"2024-{m:02d}-01 00:00:00", m, "A") for m in range(1, 7)], ddl)
    store = VersionStore(spark, str(tmp_path), first.schema, "k", ["seen", "id"], "sig")
    store.merge(first, 0)
    store.merge(rows([("a", "2024-03-15 00:00:00", 99, "B")], ddl), 1)
    assert [p.name for p in (tmp_path / "observations" / "data" / "gen=1").glob("chunk=*")] == ["chunk=2024-03"]
    got = [(f"{r.valid_from:%m-%d}", r.sig, r.valid_to and f"{r.valid_to:%m-%d}") for r in store.versions(1).orderBy("version_number").collect()]
    assert got == [("01-01", "A", "03-15"), ("03-15", "B", "04-01"), ("04-01", "A", None)]


def test_exact_quantiles_equal_percentile_on_a_hot_key(spark):
    from playmart.operators.selection import counted_quantiles, exact_quantiles

    n = F.col("id")
    rows = spark.range(30_000).select(
        F.when(n % 3 == 0, "hot").when(n % 101 == 0, None).otherwise(F.concat(F.lit("k"), (n % 17).cast("string"))).alias("k"),
        (n % 2).alias("j"),
        F.when(n % 7 == 0, None).when(n % 5 == 0, 1.5).otherwise((n * 7919) % 10_007 / 3).alias("v"),
    ).unionByName(spark.sql("select 'empty' k, 0L j, cast(null as double) v union all select 'one', 0, 4.0 union all select 'inf', 1, double('inf')"))
    fractions = {"low": 0.0, "median": 0.5, "p95": 0.95, "high": 1.0}
    want = rows.filter("v is not null").groupBy("k", "j").agg(
        *[F.percentile("v", f).alias(name) for name, f in fractions.items()])
    want = {(r["k"], r["j"]): r for r in want.collect()}
    assert len(want) > 30
    for found in (exact_quantiles, counted_quantiles):
        got = {(r["k"], r["j"]): r for r in found(rows, ["k", "j"], "v", fractions).collect()}
        assert got.keys() == want.keys()
        for key, row in want.items():
            assert [got[key][f] for f in fractions] == pytest.approx([row[f] for f in fractions]), key
    whole = exact_quantiles(rows, [], "v", {"median": 0.5}).collect()
    assert whole[0]["median"] == pytest.approx(rows.agg(F.median("v")).first()[0])
    assert exact_quantiles(rows.filter("false"), ["k"], "v", {"m": 0.5}).count() == 0
    with pytest.raises(ValueError):
        exact_quantiles(rows, ["k"], "v", {"m": 1.5})
