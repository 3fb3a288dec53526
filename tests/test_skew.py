"""One key holding a third of all rows: results stay exact.

The driver's ``events`` (sf0.001) are rewritten by Spark so that every third
event belongs to one user and browser (one hot user, one hot session per
day); queries and their DuckDB twins then run on that derived table."""

from __future__ import annotations

import os
import tempfile

import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from oracle_compare import compare, duck

NAMES = (
    "fct_sessions",
    "funnel_conversion",
    "retention_cohorts",
    "rfm_segments",
    "session_quality_flags",
    "check_results",
)


@pytest.fixture(scope="module")
def skewed_dir(spark):
    out = tempfile.mkdtemp(prefix="sessionlens-skew-")
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    hot = (F.col("event_id") % 3) == 0
    skewed = ev.select(
        "event_id",
        "ts",
        F.when(hot, F.lit(7)).otherwise(F.col("user_id")).alias("user_id"),
        "event_type",
        "value",
        F.when(hot, F.lit('{"k": 0}')).otherwise(F.col("props")).alias("props"),
    )
    skewed.coalesce(1).write.parquet(os.path.join(out, "events.parquet"))
    return out


def test_hot_key_share(spark, skewed_dir):
    ev = spark.read.parquet(os.path.join(skewed_dir, "events.parquet"))
    top = ev.groupBy("user_id").count().orderBy(F.desc("count")).first()
    assert top["count"] >= ev.count() / 3


@pytest.mark.parametrize("name", NAMES)
def test_skewed_matches_duckdb(spark, skewed_dir, name):
    r = compare(spark, name, skewed_dir, duck(skewed_dir))
    assert r.get("ok"), r
