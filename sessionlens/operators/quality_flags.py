"""M6: row-level data-quality flags. Flag, never drop: a projection only,
so the output has exactly the input's rows and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAG_COLUMNS = (
    "flag_purchase_without_checkout",
    "flag_addcart_without_view",
    "flag_revenue_without_purchase",
    "flag_negative_revenue",
)


def _as_int(flag: Column) -> Column:
    # A NULL flag counts as 0 here, while it stays NULL through the OR below.
    return F.when(flag, F.lit(1)).otherwise(F.lit(0))


def session_quality_flags(sessions: DataFrame) -> DataFrame:
    revenue = F.coalesce(F.col("revenue_usd"), F.lit(0.0))
    flagged = sessions.select(
        "session_key",
        "session_date",
        "revenue_usd",
        "did_view_item",
        "did_add_to_cart",
        "did_begin_checkout",
        "did_purchase",
        (F.col("did_purchase") & ~F.col("did_begin_checkout")).alias(FLAG_COLUMNS[0]),
        (F.col("did_add_to_cart") & ~F.col("did_view_item")).alias(FLAG_COLUMNS[1]),
        ((revenue > 0) & ~F.col("did_purchase")).alias(FLAG_COLUMNS[2]),
        (revenue < 0).alias(FLAG_COLUMNS[3]),
    )
    flags = [F.col(c) for c in FLAG_COLUMNS]
    count = _as_int(flags[0])
    any_flag = flags[0]
    for f in flags[1:]:
        count = count + _as_int(f)
        any_flag = any_flag | f
    return flagged.withColumns({"dq_flag_count": count, "has_dq_flag": any_flag})
