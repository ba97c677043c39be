"""Plan shape of every registered query: no nested-loop or cartesian joins,
no row-at-a-time Python UDFs."""

import pytest

from conftest import SMALL_SF

import __spark_entry__ as E
from switchboard.plans import catalog

QUERIES = {name: fn for name, fn in E.queries().items() if name in catalog.QUERIES}
BANNED = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_quadratic_join(spark, name):
    df = QUERIES[name](spark, SMALL_SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in BANNED:
        assert op not in plan, f"{name}: {op}"


def _plan(spark, name):
    return QUERIES[name](spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString()


def test_partition_filters_reach_the_scan(spark):
    assert "PartitionFilters: [isnotnull(event_date" in _plan(spark, "dm_star_join")
    assert "PartitionFilters: [isnotnull(load_date" in _plan(spark, "scan_partition_filter")
    billing = _plan(spark, "pruned_count_fact_billing_line")
    assert "period_month_date_month" in billing.split("PartitionFilters:")[-1].split("]")[0]
    scd2 = _plan(spark, "pruned_count_ods_agent_scd2")
    assert "eff_from_ts_year" in scd2.split("PartitionFilters:")[-1].split("]")[0]


def test_cluster_filter_pushed_to_parquet(spark):
    plan = _plan(spark, "pruned_count_ods_invoice_acid")
    assert "PushedFilters: [IsNotNull(invoice_id), EqualTo(invoice_id,1)]" in plan


def test_agent_daily_aggregates_before_the_join(spark):
    plan = _plan(spark, "agg_agent_daily")
    join_at = plan.index("BroadcastHashJoin") if "BroadcastHashJoin" in plan else plan.index("SortMergeJoin")
    below = plan[join_at:]
    assert "partial_sum" in below          # the fact side is pre-aggregated under the join
