"""Physical-plan invariants of the registered queries (scale properties,
checked rather than described)."""

import pytest

import __spark_entry__ as E

from .conftest import SMALL

QUERIES = E.queries()
SKIP = {"gbt_scores", "rf_scores", "platt", "model_eval", "promotion_gate", "perm_importance", "hpt",
        "stream_week_counts", "stream_running_counts", "stream_alerts"}


def plan(spark, name):
    df = QUERIES[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_cartesian_products(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_rule_chain_filters_reach_the_scan(spark):
    df = QUERIES["clean_kept"](spark, SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_discount)" in text or "GreaterThan(l_quantity,0.0)" in text


def test_dimension_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(spark, "dim_lookup")


def test_keep_first_is_a_partial_aggregate(spark):
    p = plan(spark, "dedup_first")
    assert "partial_min_by" in p


def test_panel_reads_the_pinned_zone_day_table(spark):
    p = plan(spark, "risk_panel")
    assert "FileScan parquet" not in p          # raw events read once, into the checkpoint


def test_curves_use_no_single_partition_window_on_scores(spark):
    df = QUERIES["roc_auc"](spark, SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step allowed is over per-partition offsets
    assert p.count("SinglePartition") <= 1
