"""Registered queries: equal to their SQL on the small tables, and with the plans we want."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from helpers import plan_of, rows
from textsignal.plans import inputs

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def by_name(columns, table):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(row[i] for i in order) for row in table], key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert by_name(df.columns, df.collect()) == by_name(columns, result.fetchall())


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


#: The caller's scorer, the automaton and the bounded counters are Python.
IN_PYTHON = {"annotate_rule", "many_subjects", "heavy_vocabulary"}


@pytest.mark.parametrize("name", sorted(set(SQL) - IN_PYTHON))
def test_no_python_and_no_cross_product(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct", plan)
    # A nested loop is only allowed for nothing at all: joins are on keys.
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_of(QUERIES["label_summary"](spark, SF))
    assert "ReadSchema: struct<l_extendedprice:double>" in plan


def test_windows_over_tokens_run_per_range(spark):
    plan = plan_of(QUERIES["segments"](spark, SF))
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("_group" in w for w in windows)


def test_segments_are_cut_once_for_queries_that_read_them_again(spark):
    plan = plan_of(inputs.stored_segments(spark, SF))
    assert "regexp_replace" not in plan and "Window" not in plan
    assert rows(inputs.stored_segments(spark, SF)) == rows(inputs.segments(spark, SF))
    for name in ("factor_mixture", "heavy_vocabulary", "topic_mixture", "topic_shares_add_up"):
        assert "regexp_replace" not in plan_of(QUERIES[name](spark, SF))


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["source", "n_segments", "n_rewh", "n_tion"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["segments", "used_vocabulary", "roc_points", "label_join", "label_histogram"])
def test_equals_sql_where_nothing_is_small_enough_to_broadcast(spark, duck, name):
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for limit in limits:
        spark.conf.set(limit, "-1")
    try:
        df = QUERIES[name](spark, SF)
        result = duck.execute(SQL[name])
        columns = [c[0] for c in result.description]
        assert by_name(df.columns, df.collect()) == by_name(columns, result.fetchall())
        assert "SortMergeJoin" in plan_of(df)
    finally:
        for limit in limits:
            spark.conf.unset(limit)
