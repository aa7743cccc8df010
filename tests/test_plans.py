"""Plan shape: pruning, pushdown, broadcasts, no fact shuffle for enrichment."""

import re

from chainsight.plans import catalog as C
from chainsight.plans import silver as S

from .conftest import SF001


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark):
    df = C.QUERIES["market_kpi"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # lineitem is read for the used columns only
    assert "l_tax" not in plan and "l_quantity" not in plan and "c_acctbal" not in plan


def test_filter_pushed_to_scan(spark):
    """The oil series' filter of the shock signal reaches the events scan."""
    plan = S.global_signals(C.bronze(spark, SF001), ["commodity_shock_flag"])["commodity_shock_flag"]
    df = spark.range(1).select(plan.alias("flag"))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)", df._jdf.queryExecution().executedPlan().toString())
    assert any({"EqualTo(event_type,purchase)", "IsNotNull(value)"} <= set(re.findall(r"\w+\([^)]*\)", p)) for p in pushed)


def test_silver_dimensions_are_broadcast(spark):
    b = C.bronze(spark, SF001)
    plan = executed(S.silver(b))
    assert plan.count("BroadcastHashJoin") >= 4  # supplier, country, storm, route
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_marts_aggregate_partially(spark):
    plan = executed(C.QUERIES["market_kpi"](spark, SF001))
    assert "HashAggregate" in plan and "partial_" in plan


def test_only_needed_enrichments(spark):
    b = C.bronze(spark, SF001)
    lean = S.silver(b, columns=["market", "is_delayed"])
    full = S.silver(b)
    assert lean.count() == full.count()
    assert "route_delay_rate" not in lean.columns
