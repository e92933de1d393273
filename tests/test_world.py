from __future__ import annotations

from pyspark.sql import functions as F

from catalog import world


def test_parts_are_dealt_out_before_they_are_described(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("Brand#12").alias("p_brand"),
                            F.lit("ECONOMY X").alias("p_type"), F.lit(3).alias("p_size")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for view in (world.raw_tracks, world.raw_external):
        assert "RepartitionByExpression [p_partkey" in view(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()


def test_spread_history_keeps_all_partitions_and_the_same_rows(spark, rows, tmp_path):
    lines = [(n // 3, n % 7, n % 4, n % 7 + 1, n % 50, "RAN"[n % 3], "OF"[n % 2], f"1996-0{n % 9 + 1}-01 00:00:00") for n in range(60)]
    rows([*lines, lines[0], (None, *lines[1][1:])],
         "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, "
         "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows([(n, n % 10, "1-URGENT") for n in range(20)],
         "o_orderkey bigint, o_custkey bigint, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spread, plain = world.spread_history(spark, str(tmp_path)), world.history(spark, str(tmp_path))
    assert spread.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > plain.rdd.getNumPartitions()
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
