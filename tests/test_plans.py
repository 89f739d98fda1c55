"""Plan-shape checks: pushdown, pre-shuffle dedup, no cartesian products."""

from pyspark.sql import functions as F

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_projection_reach_the_scan(spark):
    from refmart.plans import fixtures as fx
    li = fx.table(spark, SF_SMALL, "lineitem").filter(F.col("l_linestatus") == "O").select("l_partkey")
    p = li._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)]" in p
    assert "ReadSchema: struct<l_partkey:bigint,l_linestatus:string>" in p


def test_dedup_limits_before_the_shuffle(spark):
    from refmart.operators.windows import dedup_latest
    from refmart.plans import fixtures as fx
    out = dedup_latest(fx.table(spark, SF_SMALL, "lineitem"), ["l_partkey"], ["l_shipdate desc", "l_orderkey desc"])
    s = out._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in s and "Partial" in s


def test_reports_have_no_cartesian_product(spark):
    from __spark_entry__ import queries
    qs = queries()
    for name in ["rpt1_kpi_cards", "rpt6_venue_share", "c1_apply_delta", "c10_build_snapshot", "c4_scd2_by_version"]:
        plan = qs[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
