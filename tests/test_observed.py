"""Checks measured by the write against checks that scan the table."""

from __future__ import annotations

import pytest
from conftest import SF0001

import __spark_entry__ as E
from sessionlens.plans import checks as CK
from sessionlens.plans import observed as OB

SUITE = (
    CK.Check("k_present", "m", "not_null", "k"), CK.Check("color_known", "m", "accepted_values", "color", values=("red", "blue")),
    CK.Check("few_flags", "m", "flag_rate", "flag", severity="warn", high=0.4), CK.Check("size", "m", "volume", severity="warn", low=3, high=5),
    CK.Check("k_once", "m", "unique", "k"),
)
ROWS = {
    "good": [(1, "red", False), (2, "blue", True), (3, None, None)],
    "bad": [(None, "green", True), (1, "green", True), (1, "gray", False), (None, None, True), (5, "red", False), (6, "red", True)],
    "empty": [],
}


@pytest.mark.parametrize("name", sorted(ROWS))
def test_a_write_measures_what_a_scan_finds(spark, tmp_path, name):
    df = spark.createDataFrame(ROWS[name], "k int, color string, flag boolean")
    written = OB.write_measured(df, str(tmp_path / "m"), "m", SUITE)
    scanned = {r.check: (r.failures, r.status) for r in CK.check_results({"m": df}, SUITE, "r").collect()}
    got = {r.check: (r.failures, r.status) for r in OB.results(spark, [written], SUITE).collect()}
    assert got == {k: v for k, v in scanned.items() if k != "k_once"}
    assert written.rows == len(ROWS[name]) == written.table.count()
    # Measured checks are taken over, the others still run.
    mixed = CK.check_results({"m": written.table}, SUITE, "r", measured=written.failures)
    assert {r.check: (r.failures, r.status) for r in mixed.collect()} == scanned


def test_results_of_a_write_read_no_table(spark):
    results = E.queries()["write_checks"](spark, SF0001)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Aggregate" not in plan
    assert results.count() == 13


def test_the_write_has_one_job_with_one_scan(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as int) as k", "'red' as color", "false as flag").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    spark.sparkContext.setJobGroup("measured-write", "measured-write")
    try:
        OB.write_measured(df, str(tmp_path / "m"), "m", SUITE)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("measured-write")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
