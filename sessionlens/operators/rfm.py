"""M5: recency / frequency / monetary scores and named segments.

Purchasing sessions -> per user (shuffle on user, partial aggregation) ->
three global quintiles. The quintiles are the one global ordering in the
pipeline; their limits are found by counting (operators/quantiles.py), so a user
is written once and never sorted but among ties. Ties are broken by
``user_pseudo_id`` ascending so the tiles are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens import config as C
from sessionlens.functions import days_since, exact_sum
from sessionlens.operators.ntile import ntile, ntiles_distributed
from sessionlens.operators.quantiles import ntiles_by_counting


def rfm_purchases(sessions: DataFrame) -> DataFrame:
    """Sessions with a purchase and a known revenue."""
    return sessions.where(F.col("did_purchase") & F.col("revenue_usd").isNotNull()).select(
        "user_pseudo_id", "session_date", "revenue_usd"
    )


def rfm_user(sessions: DataFrame, as_of: str) -> DataFrame:
    """Recency (days to ``as_of``), frequency (purchasing sessions, not
    purchase events) and monetary value per user."""
    return (
        rfm_purchases(sessions)
        .groupBy("user_pseudo_id")
        .agg(
            days_since(as_of, F.max("session_date")).alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            exact_sum("revenue_usd").alias("monetary_usd"),
        )
    )


def rfm_scored(sessions: DataFrame, as_of: str, n_tiles: int = 5, method: str = "counting") -> DataFrame:
    """Adds r_score (most recent = 5), f_score and m_score (highest = 5)."""
    users = rfm_user(sessions, as_of)
    tie = F.col("user_pseudo_id").asc()
    specs = {
        "r_score": [F.col("recency_days").desc(), tie],
        "f_score": [F.col("frequency").asc(), tie],
        "m_score": [F.col("monetary_usd").asc(), tie],
    }
    if method == "counting":
        values = {"r_score": -F.col("recency_days"), "f_score": F.col("frequency"), "m_score": F.col("monetary_usd")}
        users = ntiles_by_counting(users, n_tiles, values, "user_pseudo_id")
    elif method == "distributed":
        users = ntiles_distributed(users, n_tiles, specs, "user_pseudo_id")
    else:
        for out, order in specs.items():
            users = ntile(users, n_tiles, order, out, method)
    return users.select(
        "user_pseudo_id", "recency_days", "frequency", "monetary_usd", "r_score", "f_score", "m_score"
    )


def segment_of(r: Column, f: Column) -> Column:
    """First matching rule wins; m_score is not used."""
    return (
        F.when((r >= 4) & (f >= 4), F.lit(C.SEG_CHAMPIONS))
        .when(f >= 4, F.lit(C.SEG_LOYAL))
        .when((r >= 4) & (f <= 2), F.lit(C.SEG_NEW))
        .when((r <= 2) & (f >= 3), F.lit(C.SEG_AT_RISK))
        .when(r <= 2, F.lit(C.SEG_HIBERNATING))
        .otherwise(F.lit(C.SEG_NEEDS_ATTENTION))
    )


def with_segment(scored: DataFrame) -> DataFrame:
    return scored.withColumn("segment", segment_of(F.col("r_score"), F.col("f_score")))


def rfm_segments(sessions: DataFrame, as_of: str, n_tiles: int = 5, method: str = "counting") -> DataFrame:
    return with_segment(rfm_scored(sessions, as_of, n_tiles, method))
