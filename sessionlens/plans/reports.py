"""Reporting queries over the marts.

All inputs here are small aggregates (4 funnel rows, cohort x week cells,
segments) except ``rfm_scatter`` and ``segment_*``, which aggregate the
per-user RFM table with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions import safe_pct


def segment_summary(rfm: DataFrame) -> DataFrame:
    """R2: users and mean revenue (whole dollars) per segment, largest first."""
    return (
        rfm.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("users"), F.round(F.avg("monetary_usd"), 0).alias("avg_rev"))
        .orderBy(F.desc("users"), F.asc("segment"))
    )


def retention_pct(retention: DataFrame) -> DataFrame:
    """Active users as % of the cohort's week-0 users (NULL without a
    week-0 cell). The window is partitioned by cohort: one small partition
    per cohort week."""
    cohort = Window.partitionBy("cohort_week")
    size = F.max(F.when(F.col("weeks_since") == 0, F.col("active_users"))).over(cohort)
    return retention.select(
        "cohort_week",
        "weeks_since",
        "active_users",
        size.alias("cohort_size"),
        F.round(F.try_divide(F.col("active_users") * F.lit(100.0), size), 4).alias("retention_pct"),
    )


def retention_matrix(retention: DataFrame, max_weeks: int = 8) -> DataFrame:
    """One row per cohort (as text), one column per week with the share of
    the cohort's week-0 users in percent; missing cells NULL."""
    weeks = list(range(max_weeks + 1))
    wide = (
        retention_pct(retention)
        .select(F.col("cohort_week").cast("string").alias("cohort_week"), "weeks_since", "retention_pct")
        .groupBy("cohort_week")
        .pivot("weeks_since", weeks)
        .agg(F.first("retention_pct"))
    )
    return wide.select("cohort_week", *[F.col(str(w)).alias(f"w{w}") for w in weeks])


def funnel_kpi(funnel: DataFrame) -> DataFrame:
    """Overall view-to-purchase conversion (pct_of_top of Purchase)."""
    return funnel.where(F.col("step") == "Purchase").select(
        F.col("users").alias("purchasers"), F.col("pct_of_top").alias("view_to_purchase_pct")
    )


def segment_table(rfm: DataFrame) -> DataFrame:
    """Users, mean monetary and mean frequency per segment."""
    return rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("users"),
        F.round(F.avg("monetary_usd"), 2).alias("avg_monetary_usd"),
        F.round(F.avg("frequency"), 4).alias("avg_frequency"),
    )


def rfm_scatter(rfm: DataFrame) -> DataFrame:
    """Recency, frequency, monetary and segment per user."""
    return rfm.select("user_pseudo_id", "recency_days", "frequency", "monetary_usd", "segment")


def biggest_leak(funnel: DataFrame) -> DataFrame:
    """The step with the lowest step-over-step conversion."""
    return funnel.where(F.col("pct_of_previous_step").isNotNull()).agg(
        F.min_by(F.col("step"), F.struct("pct_of_previous_step", "step_order")).alias("step"),
        F.min("pct_of_previous_step").alias("pct_of_previous_step"),
    )


def week1_retention(retention: DataFrame) -> DataFrame:
    """Week-1 retention by cohort, steepest drop first."""
    pct = retention_pct(retention)
    return (
        pct.where(F.col("weeks_since") == 1)
        .select("cohort_week", "cohort_size", F.col("active_users").alias("week1_users"), "retention_pct")
        .orderBy(F.asc("retention_pct"), F.asc("cohort_week"))
    )


def funnel_monotonic(funnel: DataFrame) -> DataFrame:
    """Steps with more users than the step before (a non-monotonic funnel)."""
    prev = F.lag("users").over(Window.orderBy("step_order"))  # 4 rows
    return (
        funnel.select("step_order", "step", "users", prev.alias("previous_users"))
        .where(F.col("users") > F.col("previous_users"))
        .withColumn("excess_pct", safe_pct(F.col("users") - F.col("previous_users"), F.col("previous_users")))
    )
