"""Physical-plan properties: pruning, pushdown, no Python UDFs, no Cartesian products."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    from contrail.fixtures import tables
    t = tables(spark, SMALL)
    df = t.orders.filter("o_orderkey > 100").select("o_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,100)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


@pytest.mark.parametrize("key", ["rpt_on_time", "rpt_route_profit", "rpt_delay_features", "rpt_rfm",
                                 "mart_daily_airline", "batch_enrich", "dash_kpi"])
def test_no_python_udf_no_cartesian(spark, key):
    plan = _plan(E.queries()[key](spark, SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{key}: {bad}"


def test_flagship_uses_broadcast_dimensions(spark):
    plan = _plan(E.queries()["rpt_on_time"](spark, SMALL))
    assert "BroadcastHashJoin" in plan


def test_bucketed_join_has_no_exchange_below_join(spark):
    # broadcast off so the co-located sort-merge join is what is checked
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["join_bucketed"](spark, SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        join_part = plan[plan.index("SortMergeJoin"):]
        assert "Exchange" not in join_part, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_report_year_reaches_the_scan(spark):
    plan = _plan(E.queries()["rpt_on_time"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in plan
