
from __future__ import annotations

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from sessionlens import config as C
from sessionlens.build import Build
from sessionlens.plans import reports as RP


@pytest.fixture(scope="module")
def build(spark):
    return Build(spark, SF001, materialize_sessions=True)


def test_segments_partition_purchasers(build):
    rfm = build.rfm
    n_users = rfm.count()
    assert rfm.select("user_pseudo_id").distinct().count() == n_users
    by_segment = {r.segment: r.n for r in rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(by_segment) <= set(C.SEGMENTS) and sum(by_segment.values()) == n_users
    purchase = build.funnel.where(F.col("step") == "Purchase").first().users
    assert purchase == n_users  # every purchaser has revenue in this data


def test_quintile_sizes_differ_by_at_most_one(build):
    for score in ("r_score", "f_score", "m_score"):
        sizes = [r.n for r in build.rfm.groupBy(score).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1, score


def test_week0_retention_is_100(build):
    pct = RP.retention_pct(build.retention).where(F.col("weeks_since") == 0)
    assert {r.retention_pct for r in pct.collect()} == {100.0}


def test_flags_keep_every_session(build):
    assert build.flags.count() == build.sessions.count()


def test_funnel_pct_of_top_has_a_100(build):
    rows = build.funnel.collect()
    assert max(r.pct_of_top for r in rows) == 100.0 and rows[0].pct_of_previous_step is None
