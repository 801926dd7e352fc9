"""What the plans must and must not hold."""

import pytest

import __spark_entry__ as registry
from tallybook import session

SF = "/root/testdata/sf0.001"
# One-row aggregates, one-row probes and tables of one row per range may sit in one partition.
SINGLE = {"top_two_and_overall_rank", "same_rows", "render_table", "constraint_report", "constraint_report_creditors"}
BATCH = [n for n in registry.core_queries() if not n.startswith("stream_")]


def plan(spark, name):
    df = registry.core_queries()[name](spark, SF)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text
    if name not in SINGLE:
        assert "SinglePartition" not in text


def test_filters_reach_the_scan(spark):
    text = plan(spark, "filter_both")
    assert "EqualTo(c_mktsegment,BUILDING)" in text and "GreaterThanOrEqual(c_acctbal,5000.0)" in text
    assert "ReadSchema: struct<c_name:string,c_acctbal:double,c_mktsegment:string>" in text
    assert "GreaterThanOrEqual(l_quantity,48.0)" in plan(spark, "distinct_groups_large_returns")
    assert "GreaterThanOrEqual(o_orderdate" in registry.core_queries()["date_parts"](spark, SF).where(
        "o_orderdate >= timestamp_ntz'1996-01-01'"
    )._jdf.queryExecution().toString()


def test_one_column_is_read_for_one_column(spark):
    assert "ReadSchema: struct<c_name:string>" in plan(spark, "project_one")


def test_rows_beyond_k_are_dropped_before_the_shuffle(spark):
    from tallybook.operators.ranking import group_leaders
    from tallybook.sources.tables import read_table

    text = group_leaders(read_table(spark, SF, "customer"), "c_nationkey", "c_acctbal", 2, "c_custkey")._jdf.queryExecution().toString()
    assert "row_number(), 2, Partial" in text


def test_shared_folder_is_the_sessions(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_location(spark, "x") != session.new_location(spark, "x")


def test_run_tables_can_be_dropped(spark, tmp_path):
    from pathlib import Path

    from tallybook.plans.durable import written_table

    session.drop_run_tables(spark)
    kept = written_table(spark.range(3).toDF("x"), "kept")
    assert kept.count() == 3
    folder = Path(session.shared_folder(spark)) / "tallybook"
    assert [p.name for p in folder.iterdir() if p.name.startswith("kept-")]
    assert session.drop_run_tables(spark) == 1
    assert not [p.name for p in folder.iterdir() if p.name.startswith("kept-")]
