"""Plan shape of registered queries: pruned scans, pushed filters, top-1
before the shuffle, no Python outside the probe."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def read_columns(p, table):
    m = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*" + re.escape(f"{table}.parquet"), p)
    return m.group(1).split(",") if m else None


@pytest.mark.parametrize("name,table,n_cols", [
    ("silver_summary", "orders", 1),
    ("link_resolve", "lineitem", 2),
    ("content_hash", "documents", 2),
    ("validate_contract", "customer", 2),
])
def test_scans_read_only_needed_columns(spark, name, table, n_cols):
    cols = read_columns(plan(spark, name), table)
    assert cols is not None and len(cols) == n_cols


def test_entity_filters_reach_the_scan(spark):
    p = plan(spark, "link_resolve")
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in p and "PushedFilters: [IsNotNull(p_partkey)]" in p


@pytest.mark.parametrize("name", ["silver_build", "dedup_latest", "dedup_latest_composite"])
def test_top1_is_cut_before_the_exchange(spark, name):
    p = plan(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", p)
    assert p.index("Final") < p.index("Partial")  # final above the exchange, partial below


def test_python_runs_only_in_the_probe(spark):
    for name in E.queries():
        if name in ("csv_structure_probe",) or name.startswith(("landing_", "bronze_", "change_", "upload_")):
            continue
        p = plan(spark, name)
        assert not re.search(r"MapInPandas|ArrowEvalPython|BatchEvalPython", p), name


def test_bounded_broadcast(spark):
    from sluice.functions.sizing import bounded_broadcast

    df = spark.range(100).selectExpr("id AS `a b`", "repeat('x', 50) AS t", "array('y', null) AS l")
    assert bounded_broadcast(df, 4_000) is df
    assert "BroadcastHashJoin" in spark.range(10**9).join(bounded_broadcast(df), F.col("id") == F.col("a b"))._jdf.queryExecution().executedPlan().toString()
