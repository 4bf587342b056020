"""Plans stay distributed: no cross products, no Python rows, columns pruned at the scan."""

import re

import pytest

from nightledger.plans.catalog import registered

FOLDER = "/root/testdata/sf0.001"
QUERIES = registered()
TRAINED = {"gbt_score", "gbt_stump_score", "gbt_patience", "gbt_staged_losses", "grid_search", "grid_search_axes", "grid_search_stump"}
PLANNED = sorted(set(QUERIES) - TRAINED)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_product_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan


def test_joins_work_without_broadcast(spark):
    """With broadcasting off every join still finds an equi-key."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("orders_enriched", "batch_asof", "lookback_mhtl_efdt", "modal_correction"):
            plan = plan_of(QUERIES[name](spark, FOLDER))
            assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(QUERIES["modal_category"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    orders = [s for s in schemas if "o_custkey" in s]
    assert orders and all("o_totalprice" not in s and "o_orderdate" not in s for s in orders)


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["null_rates"](spark, FOLDER))
    assert "EqualTo(o_orderstatus,F)" in plan


def test_bucketed_blocks_join_without_an_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["feature_assembly_bucketed"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan and "Bucketed: true" in plan
