"""Every registered query against its DuckDB twin on the driver tables.

Runs at sf0.001 (set SESSIONLENS_ORACLE_SF to another folder, e.g. sf0.01,
for the driver's scale)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from sessionlens import catalog
from sessionlens.oracle_sql import oracle_sql

SF = os.environ.get("SESSIONLENS_ORACLE_SF", "/root/testdata/sf0.001")
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(oracle_sql()) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r.get("ok"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [c for c in df.columns] == ["step_order", "step", "users", "pct_of_top", "pct_of_previous_step"]
    assert len(rows) == 4


def test_irregular_events_reach_the_answers(spark):
    """The queries about faults report some on the driver's data."""
    one = {n: E.queries()[n](spark, SF).first() for n in ("duplicate_param_keys", "null_session_guard", "build_reconciliation")}
    assert one["duplicate_param_keys"].events_with_duplicate_keys > 0
    assert one["null_session_guard"].dropped_events > 0
    assert one["build_reconciliation"].only_left > 0 and not one["build_reconciliation"].equal
    drift = {r.param_key: r.status for r in E.queries()["schema_drift"](spark, SF).collect()}
    assert drift == {"ga_session_id": "ok", "page_location": "ok", "engagement_time_msec": "new_key"}
    failed = {r.check for r in E.queries()["check_results"](spark, SF).where("status = 'fail'").collect()}
    assert {"not_null_fct_sessions_session_key", "not_null_fct_sessions_did_purchase", "duplicate_param_keys_stg_ga4__events"} <= failed


def test_a_day_without_sessions_is_an_anomaly(spark, tmp_path):
    from pyspark.sql import functions as F

    events = spark.read.parquet(f"{SF}/events.parquet")
    events.where(F.to_date("ts") != "2024-01-10").write.parquet(str(tmp_path / "events.parquet"))
    r = compare(spark, "daily_volume_anomaly", str(tmp_path), duck(str(tmp_path)))
    assert r.get("ok"), r
    rows = {str(x.session_date): x for x in E.queries()["daily_volume_anomaly"](spark, str(tmp_path)).collect()}
    assert rows["2024-01-10"].sessions == 0 and rows["2024-01-10"].is_anomaly
