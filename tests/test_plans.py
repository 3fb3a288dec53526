"""Physical-plan properties that matter at scale (checked on sf0.001)."""

from __future__ import annotations

import re

import pytest
from conftest import SF0001

import __spark_entry__ as E
from sessionlens.build import Build


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def build(spark):
    return Build(spark, SF0001)


def test_window_reaches_the_scan(build):
    plan = plan_of(build.raw)
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_staging_is_a_projection(build):
    plan = plan_of(build.staged)
    assert "Exchange" not in plan
    assert "Generate" not in plan and "Join" not in plan


def test_sessions_hash_aggregate_over_events(build):
    plan = plan_of(build.sessions)
    # The pass over raw events is a hash aggregation with map-side combine.
    first = plan.rsplit("Aggregate(", 1)[0].rsplit("\n", 1)[-1] + "Aggregate("
    assert "HashAggregate(" in first
    assert "partial_count" in plan


def test_rfm_scores_are_a_projection_of_written_users(spark):
    plan = plan_of(E.queries()["rfm_scored"](spark, SF0001))
    # The limits of the tiles are known: no window, sort, join or shuffle is left.
    assert "FileScan parquet" in plan
    assert not [w for w in ("ntile(", "Window", "Sort", "Join", "Exchange", "Aggregate") if w in plan]


def test_rfm_by_sorting_has_no_single_partition_sort(spark):
    from sessionlens.config import Params
    from sessionlens.catalog import queries

    plan = plan_of(queries(Params(ntile_method="distributed"))["rfm_scored"](spark, SF0001))
    # After the written sorts only the per-partition offsets (bounded) cross a
    # single-partition exchange.
    assert "ntile(" not in plan
    assert "BroadcastExchange" in plan


def test_no_cartesian_products_or_python(spark):
    for name in ("owner_alerts", "governance_gaps", "flags_keep_rows", "build_reconciliation", "retention_cohorts"):
        plan = plan_of(E.queries()[name](spark, SF0001))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
        assert "EvalPython" not in plan and "InPandas" not in plan, name


def test_retention_does_not_broadcast_users(spark):
    plan = plan_of(E.queries()["retention_cohorts"](spark, SF0001))
    assert "BroadcastExchange" not in plan


def test_flatten_shuffles_no_event(spark):
    plan = plan_of(E.queries()["flatten_params"](spark, SF0001))
    assert "Exchange" not in plan and "Generate" not in plan


def test_session_attributes_hash_the_events(spark):
    plan = plan_of(E.queries()["session_attributes"](spark, SF0001))
    # The node over the scan (the last in the plan) is a hash aggregate.
    assert re.findall(r"(\w+Aggregate)\(", plan)[-1] == "HashAggregate"


def test_reconciliation_builds_each_side_once(spark):
    plan = plan_of(E.queries()["build_reconciliation"](spark, SF0001))
    assert plan.count("FileScan parquet") <= 2


def test_marts_without_attributes_shuffle_sessions_once(build):
    plan = plan_of(build.core)
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_duplicate_keys_check_computes_the_params_once(spark, build):
    # A filter on the counts computes an event's params anew for each use; an
    # aggregate shares them.
    from sessionlens.operators.staging import duplicate_param_keys
    from sessionlens.plans import checks as CK

    suite = tuple(c for c in CK.default_suite() if c.kind == "duplicate_keys")
    out = CK.check_failures({}, suite, build.raw)
    filters = [line for line in plan_of(out).splitlines() if "Filter " in line]
    assert not [f for f in filters if "array_remove" in f]
    assert out.first().failures == duplicate_param_keys(build.raw).count() > 0
    assert CK.check_failures({}, suite, build.raw.limit(0)).first().failures == 0
