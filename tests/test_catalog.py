"""Registered queries agree with their SQL on the smallest tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, rows_of

D = "/root/testdata/sf0.001"
SAMPLE = ["monthly_coverage", "g2_dedupe_play_events", "g4_scd2_from_signature", "o1_dense_surrogate",
          "i1_allocation_reconciliation", "k13_sunburst_nodes", "l6_silent_stretches",
          "p5_split_misses", "q1_plays_daily", "r2_detect_gaps", "j10_shift_runs"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{D}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    from catalog.base import QUERIES

    apart = {name for name in entry.queries() if name == "pipeline" or re.match(r"op\d+_", name)}
    assert set(entry.oracle_sql()) - apart == set(QUERIES) - apart == set(entry.queries()) - apart


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, D)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
