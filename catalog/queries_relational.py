"""The relational primitives the reports rest on, each on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog import oracle as o
from catalog import world as w
from catalog.base import day, query, r, table, utc
from playmart.operators.ordered import keep_first, top_per_group
from playmart.operators.selection import exact_quantiles
from playmart.operators.sets import (
    is_subset, lump_rest, missing_keys, shared_keys, tagged, with_share,
)
from playmart.plans.content import unanimous
from playmart.session import small_table


def t(spark, d, name):
    return table(spark, d, name)


# --- joins ----------------------------------------------------------------------------------------


@query("c1_inner_join", "SELECT p_brand, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def c1(spark, d):
    return t(spark, d, "lineitem").select("l_partkey", "l_quantity").join(
        t(spark, d, "part").select("p_partkey", "p_brand"), F.expr("l_partkey = p_partkey")
    ).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("qty"))


@query("c2_left_join", "SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def c2(spark, d):
    per = t(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return t(spark, d, "customer").select("c_custkey").join(
        per, F.expr("c_custkey = o_custkey"), "left"
    ).select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))


@query("c3_left_join_constant", "SELECT c_custkey, count(o_orderkey) AS urgent FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT' GROUP BY 1")
def c3(spark, d):
    urgent = t(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return t(spark, d, "customer").select("c_custkey").join(
        urgent, F.expr("c_custkey = o_custkey"), "left"
    ).select("c_custkey", F.coalesce("n", F.lit(0)).alias("urgent"))


@query("c4_full_outer_coalesce", """WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 49), b AS (SELECT p_partkey AS k, p_name FROM part WHERE p_size < 10)
 SELECT coalesce(a.k, b.k) AS part, coalesce(p_name, '(unnamed)') AS name, a.k IS NOT NULL AS is_referenced FROM a FULL JOIN b ON a.k = b.k""")
def c4(spark, d):
    used = t(spark, d, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("part")).distinct().withColumn("seen", F.lit(True))
    known = t(spark, d, "part").filter("p_size < 10").select(F.col("p_partkey").alias("part"), "p_name")
    return used.join(known, "part", "full_outer").select(
        "part", F.coalesce("p_name", F.lit("(unnamed)")).alias("name"), F.col("seen").isNotNull().alias("is_referenced")
    )


@query("c5_full_outer_compare", """WITH a AS (SELECT o_custkey % 50 AS g, count(*) AS n FROM orders WHERE o_custkey % 50 <> 3 GROUP BY 1), b AS (SELECT o_custkey % 50 AS g, count(*) AS n FROM orders WHERE o_orderkey % 100 <> 1 AND o_custkey % 50 <> 4 GROUP BY 1)
 SELECT coalesce(a.g, b.g) AS grp, a.n AS left_n, b.n AS right_n FROM a FULL JOIN b ON a.g = b.g WHERE a.n IS DISTINCT FROM b.n""")
def c5(spark, d):
    g = (F.col("o_custkey") % 50).alias("grp")
    count = lambda df, name: df.groupBy(g).agg(F.count(F.lit(1)).alias(name))
    orders = t(spark, d, "orders")
    left = count(orders.filter("o_custkey % 50 <> 3"), "left_n")
    right = count(orders.filter("o_orderkey % 100 <> 1 and o_custkey % 50 <> 4"), "right_n")
    return left.join(right, "grp", "full_outer").filter(~F.col("left_n").eqNullSafe(F.col("right_n")))


@query("c6_anti_join", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def c6(spark, d):
    big = t(spark, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t(spark, d, "customer").select("c_custkey").join(big, "c_custkey", "left_anti")


@query("c7_anti_join_minute", """SELECT a.event_id FROM events a WHERE event_type IN ('view', 'click') AND NOT EXISTS (SELECT 1 FROM events b WHERE b.event_type NOT IN ('view', 'click')
 AND b.user_id % 5 = a.user_id % 5 AND date_trunc('minute', b.ts) = date_trunc('minute', a.ts))""")
def c7(spark, d):
    e = t(spark, d, "events").select("event_id", "event_type", (F.col("user_id") % 5).alias("p"), F.date_trunc("minute", utc("ts")).alias("m"))
    api = F.col("event_type").isin("view", "click")
    return e.filter(api).join(e.filter(~api).select("p", "m").distinct(), ["p", "m"], "left_anti").select("event_id")


@query("c9_semi_join", "SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)")
def c9(spark, d):
    hot = t(spark, d, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return t(spark, d, "part").select("p_partkey").join(hot, "p_partkey", "left_semi")


@query("c9_exists_flag", "SELECT p_partkey, EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49) AS has_large FROM part")
def c9_flag(spark, d):
    hot = t(spark, d, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return tagged(t(spark, d, "part").select("p_partkey"), hot, ["p_partkey"], "has_large")


@query("c10_lateral_ordinality", """SELECT doc_id, i AS ordinal, w AS word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents) WHERE w <> ''""")
def c10(spark, d):
    return t(spark, d, "documents").select(
        "doc_id", F.posexplode(F.split("text", " ")).alias("at", "word")
    ).filter("word <> ''").select("doc_id", (F.col("at") + 1).alias("ordinal"), "word")


@query("c11_lateral_concat", "SELECT w, count(*) AS n FROM (SELECT unnest(list_concat([p_brand], string_split(p_name, ' '))) AS w FROM part) GROUP BY 1")
def c11(spark, d):
    return t(spark, d, "part").select(
        F.explode(F.concat(F.array("p_brand"), F.split("p_name", " "))).alias("w")
    ).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


@query("c12_step_self_join", """WITH s AS (SELECT l_linenumber AS n, count(*) AS c FROM lineitem GROUP BY 1) SELECT a.n AS step, a.c - b.c AS change FROM s a JOIN s b ON b.n = a.n - 1""")
def c12(spark, d):
    s = t(spark, d, "lineitem").groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("c"))
    before = s.select((F.col("l_linenumber") + 1).alias("l_linenumber"), F.col("c").alias("b"))
    return s.join(before, "l_linenumber").select(F.col("l_linenumber").alias("step"), (F.col("c") - F.col("b")).alias("change"))


@query("c13_unordered_pairs", """WITH s AS (SELECT n_nationkey AS k, n_regionkey AS g FROM nation JOIN (SELECT DISTINCT c_nationkey FROM customer) ON c_nationkey = n_nationkey) SELECT a.k AS one, b.k AS other FROM s a JOIN s b ON a.g = b.g AND a.k < b.k""")
def c13(spark, d):
    used = t(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    n = t(spark, d, "nation").join(used, "n_nationkey", "left_semi")
    a = n.select(F.col("n_nationkey").alias("one"), "n_regionkey")
    b = n.select(F.col("n_nationkey").alias("other"), "n_regionkey")
    return a.join(b, "n_regionkey").filter("one < other").drop("n_regionkey")


@query("c15_weighted_fan_out", """WITH g AS (SELECT DISTINCT p_brand, p_type, 1.0 / count(DISTINCT p_type) OVER (PARTITION BY p_brand) AS w FROM part),
 q AS (SELECT p_brand, sum(l_quantity) AS q FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) SELECT p_type, round(sum(q * w), 4) AS qty FROM q JOIN g USING (p_brand) GROUP BY 1""")
def c15(spark, d):
    part = t(spark, d, "part")
    kinds = part.select("p_brand", "p_type").distinct()
    n = kinds.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    weights = kinds.join(n, "p_brand").withColumn("w", F.lit(1.0) / F.col("n"))
    per_part = t(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    per_brand = per_part.join(part, F.expr("l_partkey = p_partkey")).groupBy("p_brand").agg(F.sum("q").alias("q"))
    return per_brand.join(weights, "p_brand").groupBy("p_type").agg(F.round(F.sum(F.col("q") * F.col("w")), 4).alias("qty"))


@query("c16_star_join", """SELECT r_name, p_brand, year(o_orderdate) AS year, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")
def c16(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    od = t(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    return (
        li.join(od, F.expr("l_orderkey = o_orderkey"))
        .join(t(spark, d, "customer").select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"))
        .join(t(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(t(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
        .join(t(spark, d, "part").select("p_partkey", "p_brand"), F.expr("l_partkey = p_partkey"), "left")
        .groupBy("r_name", "p_brand", "year").agg(F.count(F.lit(1)).alias("n"))
    )


@query("c17_join_with_default", """WITH s(t, b) AS (VALUES ('ECONOMY', 'pop'), ('LARGE', 'rock')) SELECT coalesce(b, 'other') AS bucket, count(*) AS n FROM part LEFT JOIN s ON t = p_type GROUP BY 1""")
def c17(spark, d):
    seed = small_table(spark, [("ECONOMY", "pop"), ("LARGE", "rock")], "p_type string, b string")
    per = t(spark, d, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("c"))
    return per.join(seed, "p_type", "left").groupBy(F.coalesce("b", F.lit("other")).alias("bucket")).agg(F.sum("c").alias("n"))


@query("c18_scalar_subquery", "SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def c18(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    newest = t(spark, d, "orders").agg(F.max("o_orderdate")).scalar()
    return orders.filter(F.col("o_orderdate") == newest).select("o_orderkey")


@query("c19_fallback_join", """WITH a AS (SELECT p_partkey, p_name || p_brand AS nm FROM part WHERE p_size <= 25), b AS (SELECT p_partkey + 1 AS k, p_name || p_brand AS nm, p_partkey AS o FROM part WHERE p_size > 25),
 n AS (SELECT nm, min(o) AS o FROM b GROUP BY 1) SELECT a.p_partkey, coalesce(b.o, n.o) AS other FROM a LEFT JOIN b ON b.k = a.p_partkey LEFT JOIN n ON n.nm = a.nm""")
def c19(spark, d):
    part = t(spark, d, "part").select("p_partkey", "p_size", F.concat("p_name", "p_brand").alias("nm"))
    right = part.filter("p_size > 25")
    by_id = right.select((F.col("p_partkey") + 1).alias("p_partkey"), F.col("p_partkey").alias("o1"))
    by_name = right.groupBy("nm").agg(F.min("p_partkey").alias("o2"))
    return part.filter("p_size <= 25").join(by_id, "p_partkey", "left").join(by_name, "nm", "left").select(
        "p_partkey", F.coalesce("o1", "o2").alias("other")
    )


# --- aggregates -----------------------------------------------------------------------------------


@query("d1_counts", "SELECT o_orderstatus, count(*) AS n, count(CASE WHEN o_totalprice > 1000 THEN 1 END) AS priced, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def d1(spark, d):
    return t(spark, d, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("o_totalprice") > 1000, 1)).alias("priced"),
        F.count_distinct("o_custkey").alias("customers"),
    )


@query("d2_filtered_aggregates", "SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned, CAST(sum(l_quantity) FILTER (l_linestatus = 'O') AS BIGINT) AS open_qty FROM lineitem GROUP BY 1")
def d2(spark, d):
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).cast("bigint").alias("open_qty"),
    )


@query("d3_conditional_distinct", "SELECT l_suppkey, count(DISTINCT l_partkey) FILTER (l_quantity > 25) AS parts FROM lineitem GROUP BY 1")
def d3(spark, d):
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count_distinct(F.when(F.col("l_quantity") > 25, F.col("l_partkey"))).alias("parts")
    )


@query("d4_unanimous_value", "SELECT o_custkey, CASE WHEN count(DISTINCT s) = 1 THEN min(s) END AS status FROM (SELECT o_custkey, CASE WHEN o_totalprice > 400000 THEN o_orderstatus END AS s FROM orders) GROUP BY 1")
def d4(spark, d):
    s = F.when(F.col("o_totalprice") > 400_000, F.col("o_orderstatus"))
    return t(spark, d, "orders").groupBy("o_custkey").agg(unanimous(s).alias("status"))


@query("d5_min_max", "SELECT o_custkey, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last, min(o_orderpriority) AS low, max(o_orderpriority) AS high FROM orders GROUP BY 1")
def d5(spark, d):
    return t(spark, d, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"),
        F.min("o_orderpriority").alias("low"), F.max("o_orderpriority").alias("high"),
    ).withColumns({"first": day("first"), "last": day("last")})


@query("d6_ordered_string_agg", "SELECT p_brand, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS types FROM part GROUP BY 1")
def d6(spark, d):
    pairs = t(spark, d, "part").select("p_brand", "p_type").distinct()
    return pairs.groupBy("p_brand").agg(F.expr("listagg(p_type, '|') within group (order by p_type)").alias("types"))


@query("d7_first_by_order", "SELECT l_partkey, arg_min(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) AS first_order FROM lineitem GROUP BY 1")
def d7(spark, d):
    return t(spark, d, "lineitem").groupBy("l_partkey").agg(
        F.min_by("l_orderkey", F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("first_order")
    )


@query("d8_bool_aggregates", "SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned, bool_and(l_linestatus = 'O') AS all_open FROM lineitem GROUP BY 1")
def d8(spark, d):
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"),
        F.bool_and(F.col("l_linestatus") == "O").alias("all_open"),
    )


@query("d9_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 15")
def d9(spark, d):
    return t(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 15")


@query("d10_null_preserving_sum", "SELECT l_suppkey, l_linenumber, CAST(sum(CASE WHEN l_linenumber <> 7 THEN l_quantity END) AS BIGINT) AS qty FROM lineitem GROUP BY 1, 2")
def d10(spark, d):
    return t(spark, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(
        F.sum(F.when(F.col("l_linenumber") != 7, F.col("l_quantity"))).cast("bigint").alias("qty")
    )


@query("d11_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def d11(spark, d):
    return t(spark, d, "part").select("p_brand", "p_type").distinct()


@query("d12_two_level_aggregate", """WITH a AS (SELECT l_orderkey, l_returnflag, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2) SELECT l_returnflag, count(*) AS orders, CAST(sum(q) AS BIGINT) AS qty FROM a GROUP BY 1""")
def d12(spark, d):
    return t(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.max("l_quantity").alias("q")).groupBy(
        "l_returnflag"
    ).agg(F.count(F.lit(1)).alias("orders"), F.sum("q").cast("bigint").alias("qty"))


@query("d13_group_of_group", "SELECT n, count(*) AS customers FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1")
def d13(spark, d):
    return t(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("customers"))


@query("d14_mean_median_mode", """WITH m AS (SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2), k AS (SELECT l_suppkey, arg_min(l_quantity, (-n, l_quantity)) AS mode FROM m GROUP BY 1)
 SELECT l.l_suppkey, round(avg(l.l_quantity), 4) AS mean, median(l.l_quantity) AS median, any_value(mode) AS mode FROM lineitem l JOIN k USING (l_suppkey) GROUP BY 1""")
def d14(spark, d):
    # one row per distinct quantity, so the mode needs no second pass over the lines
    counts = t(spark, d, "lineitem").groupBy("l_suppkey", "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    q = F.col("l_quantity")
    return counts.groupBy("l_suppkey").agg(
        F.round(F.sum(q * F.col("n")) / F.sum("n"), 4).alias("mean"),
        F.percentile("l_quantity", 0.5, F.col("n")).alias("median"),
        F.min_by("l_quantity", F.struct(-F.col("n"), q)).alias("mode"),
    )


@query("d14_exact_quantiles", """SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95,
 min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1, 2""")
def d14_quantiles(spark, d):
    """Nearly every price differs, and a few keys hold all rows: no buffer may hold a key's prices."""
    found = exact_quantiles(
        t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice",
        {"median": 0.5, "p95": 0.95, "low": 0.0, "high": 1.0},
    )
    return found.withColumns({"median": r("median"), "p95": r("p95")})


@query("d15_pivot", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def d15(spark, d):
    return t(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).fillna(0)


@query("d16_share_of_group", "WITH a AS (SELECT o_custkey % 10 AS g, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) SELECT g, o_orderstatus, n, round(100.0 * n / sum(n) OVER (PARTITION BY g), 4) AS share FROM a")
def d16(spark, d):
    counts = t(spark, d, "orders").groupBy((F.col("o_custkey") % 10).alias("g"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, "n", ["g"], "share").withColumn("share", r("share"))


@query("d17_lump_rest", """WITH a AS (SELECT l_linestatus AS s, p_brand AS b FROM lineitem JOIN part ON l_partkey = p_partkey), k AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY n DESC, b) AS rk FROM (SELECT s, b, count(*) AS n FROM a GROUP BY 1, 2))
 SELECT a.s, CASE WHEN rk <= 6 THEN a.b ELSE 'other' END AS brand, count(*) AS n FROM a JOIN k ON a.s = k.s AND a.b = k.b GROUP BY 1, 2""")
def d17(spark, d):
    rows = t(spark, d, "lineitem").select("l_partkey", F.col("l_linestatus").alias("s")).join(
        t(spark, d, "part").select("p_partkey", "p_brand"), F.expr("l_partkey = p_partkey")
    )
    return lump_rest(rows, F.col("p_brand"), ["s"], 6, "brand").groupBy("s", "brand").agg(F.count(F.lit(1)).alias("n"))


@query("d18_null_groups", "SELECT CASE WHEN o_custkey % 4 <> 0 THEN o_orderpriority END AS priority, count(*) AS n FROM orders GROUP BY 1")
def d18(spark, d):
    p = F.when(F.col("o_custkey") % 4 != 0, F.col("o_orderpriority")).alias("priority")
    return t(spark, d, "orders").groupBy(p).agg(F.count(F.lit(1)).alias("n"))


# --- windows, order, limits -----------------------------------------------------------------------


@query("e9_rank_within_year", """WITH a AS (SELECT year(o_orderdate) AS y, o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2), k AS (SELECT y, o_custkey, row_number() OVER (PARTITION BY y ORDER BY round(v, 2) DESC, o_custkey) AS rank FROM a) SELECT * FROM k WHERE rank <= 10""")
def e9(spark, d):
    sums = t(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y"), "o_custkey").agg(F.sum("o_totalprice").alias("v"))
    return top_per_group(sums, ["y"], [F.round("v", 2).desc(), F.asc("o_custkey")], 10).drop("v")


@query("e10_rolling_mean", """WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) SELECT CAST(day AS VARCHAR) AS day, round(CASE WHEN count(n) OVER w >= 3 THEN avg(n) OVER w END, 4) AS rolling FROM a
 WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def e10(spark, d):
    from playmart.plans.timeseries import rolling_mean

    daily = t(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("period")).agg(F.count(F.lit(1)).alias("n"))
    one = daily.withColumn("all_", F.lit(0))  # one row per day: the series itself is the group
    return rolling_mean(one, "n", 7, "rolling", ["all_"]).select(day("period", "day"), r("rolling"))


@query("e12_centred_window", """WITH a AS (SELECT o_custkey % 20 AS g, year(o_orderdate) * 12 + month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2)
 SELECT a.g, a.m, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS around FROM a LEFT JOIN a b ON a.g = b.g AND b.m <> a.m AND abs(a.m - b.m) <= 6 GROUP BY 1, 2""")
def e12(spark, d):
    m = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    monthly = t(spark, d, "orders").groupBy((F.col("o_custkey") % 20).alias("g"), m.alias("m")).agg(F.count(F.lit(1)).alias("n"))
    near = Window.partitionBy("g").orderBy("m").rangeBetween(-6, 6)
    return monthly.select("g", "m", (F.sum("n").over(near) - F.col("n")).alias("around"))


@query("e14_overlap_with_previous", """WITH f AS (SELECT l_suppkey AS s, year(l_shipdate) * 10 + l_linenumber % 2 AS f, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem GROUP BY 1, 2)
 SELECT s, f, coalesce(a <= lag(b) OVER (PARTITION BY s ORDER BY a, f), FALSE) AS overlaps FROM f""")
def e14(spark, d):
    files = t(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").alias("s"), (F.year("l_shipdate") * 10 + F.col("l_linenumber") % 2).alias("f")
    ).agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    before = F.lag("b").over(Window.partitionBy("s").orderBy("a", "f"))  # two files a year and supplier
    return files.select("s", "f", F.coalesce(F.col("a") <= before, F.lit(False)).alias("overlaps"))


@query("f1_order_by_keys", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 50")
def f1(spark, d):
    return t(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        "o_orderpriority", F.desc("o_totalprice"), "o_orderkey"
    ).limit(50)


@query("f2_limit", "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def f2(spark, d):
    return t(spark, d, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(25).select("o_orderkey")


@query("f3_top_k", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 10")
def f3(spark, d):
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l_suppkey").limit(10)


@query("f4_top_k_and_rest", """WITH a AS (SELECT p_type AS g, p_brand AS b, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY q DESC, b) AS rk FROM a)
 SELECT g, CASE WHEN rk <= 5 THEN b ELSE '(rest)' END AS brand, CAST(sum(q) AS BIGINT) AS qty, count(*) AS members FROM k GROUP BY 1, 2""")
def f4(spark, d):
    per = t(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q")).join(
        t(spark, d, "part"), F.expr("l_partkey = p_partkey")
    ).groupBy(F.col("p_type").alias("g"), F.col("p_brand").alias("b")).agg(F.sum("q").alias("q"))
    head = top_per_group(per, ["g"], [F.desc("q"), F.asc("b")], 5).select("g", "b", F.lit(True).alias("top"))
    brand = F.when(F.col("top"), F.col("b")).otherwise("(rest)")
    return per.join(head, ["g", "b"], "left").groupBy("g", brand.alias("brand")).agg(
        F.sum("q").cast("bigint").alias("qty"), F.count(F.lit(1)).alias("members")
    )


@query("f5_argmax_argmin", """WITH a AS (SELECT o_custkey % 10 AS g, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n FROM orders GROUP BY 1, 2)
 SELECT g, CAST(arg_min(m, (-n, m)) AS VARCHAR) AS busiest, CAST(arg_min(m, (n, m)) AS VARCHAR) AS quietest FROM a GROUP BY 1""")
def f5(spark, d):
    monthly = t(spark, d, "orders").groupBy((F.col("o_custkey") % 10).alias("g"), F.trunc("o_orderdate", "month").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    return monthly.groupBy("g").agg(
        F.min_by("m", F.struct(-F.col("n"), "m")).alias("busiest"), F.min_by("m", F.struct("n", "m")).alias("quietest")
    ).withColumns({"busiest": day("busiest"), "quietest": day("quietest")})


# --- set operations -------------------------------------------------------------------------------


@query("h1_union_all", "SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY 1")
def h1(spark, d):
    both = t(spark, d, "customer").select(F.col("c_nationkey").alias("k")).unionByName(t(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))
    return both.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("h2_unknown_members", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT -1, '(unknown)'")
def h2(spark, d):
    from playmart.plans.star import with_members

    return with_members(t(spark, d, "nation").select("n_nationkey", "n_name"), {"n_nationkey": -1, "n_name": "(unknown)"})


@query("h3_steps_in_one_pass", """SELECT 1 AS step, count(*) AS n FROM lineitem UNION ALL SELECT 2, count(*) FROM lineitem WHERE l_quantity > 10 UNION ALL SELECT 3, count(*) FROM lineitem WHERE l_quantity > 10 AND l_returnflag = 'R'""")
def h3(spark, d):
    big = F.col("l_quantity") > 10
    depth = F.when(big & (F.col("l_returnflag") == "R"), 3).when(big, 2).otherwise(1)
    sums = t(spark, d, "lineitem").groupBy(depth.alias("depth")).agg(F.count(F.lit(1)).alias("c"))
    return sums.select("c", F.explode(F.sequence(F.lit(1), F.col("depth"))).alias("step")).groupBy("step").agg(F.sum("c").alias("n"))


@query("h4_set_difference", "SELECT DISTINCT o_custkey AS c FROM orders WHERE o_orderpriority = '1-URGENT' EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'")
def h4(spark, d):
    rows = t(spark, d, "orders").select("o_orderpriority", F.col("o_custkey").alias("c"))
    urgent = rows.filter("o_orderpriority = '1-URGENT'")
    return missing_keys(urgent, rows.filter("o_orderpriority = '5-LOW'"), ["c"])


@query("h5_set_intersection", "SELECT o_custkey AS c FROM orders WHERE o_orderpriority = '1-URGENT' INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'")
def h5(spark, d):
    rows = t(spark, d, "orders").select("o_orderpriority", F.col("o_custkey").alias("c"))
    urgent = rows.filter("o_orderpriority = '1-URGENT'")
    return shared_keys(urgent, rows.filter("o_orderpriority = '5-LOW'"), ["c"])


@query("h6_subset_test", "SELECT count(*) AS outside, count(*) = 0 AS is_subset FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 5))")
def h6(spark, d):
    left = t(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    right = t(spark, d, "customer").filter("c_nationkey <> 5").select(F.col("c_custkey").alias("k"))
    return is_subset(left, right, ["k"])


@query("a1_read_raw_feed", f"""WITH {o.EVENTS} SELECT 'p' || (user_id % 5) AS profile_slug, count(DISTINCT user_id * 1000000 + event_id // 2000) AS pages FROM ev WHERE api GROUP BY 1""")
def a1(spark, d):
    from playmart.session import shared_dir
    from playmart.sources.readers import read_raw
    from playmart.sources.writers import append_responses, response_rules
    import uuid

    path = f"{shared_dir(spark)}/raw-{uuid.uuid4().hex}"
    append_responses(w.captured_pages(spark, d).unionByName(w.raw_tracks(spark, d)), path, response_rules())
    return read_raw(spark, path, "recently_played").groupBy("profile_slug").agg(F.count(F.lit(1)).alias("pages"))


@query("a4_read_seed", "SELECT p_type AS genre_name, CASE WHEN p_type < 'M' THEN 'pop' ELSE 'rock' END AS bucket_name FROM part GROUP BY 1")
def a4(spark, d):
    from playmart.session import shared_dir
    from playmart.sources.readers import read_seed
    from playmart.sources.schemas import GENRE_BUCKET_MAP
    from playmart.sources.writers import write_extract
    import uuid

    path = f"{shared_dir(spark)}/seed-{uuid.uuid4().hex}"
    seed = t(spark, d, "part").select(F.col("p_type").alias("genre_name")).distinct().withColumn(
        "bucket_name", F.when(F.col("genre_name") < "M", "pop").otherwise("rock")
    )
    write_extract(seed, path)
    return read_seed(spark, path, GENRE_BUCKET_MAP)


@query("keep_first_vs_distinct_on", "SELECT DISTINCT ON (l_partkey) l_partkey, l_orderkey, l_linenumber FROM lineitem ORDER BY l_partkey, l_shipdate DESC, l_orderkey, l_linenumber")
def keep_first_q(spark, d):
    return keep_first(
        t(spark, d, "lineitem"), ["l_partkey"], [F.desc("l_shipdate"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    ).select("l_partkey", "l_orderkey", "l_linenumber")
