"""M3: user-level purchase funnel, long form (4 rows).

sessions -> per user (shuffle on user, partial bool_or) -> one global row of
four counts (partial count_if, one tiny final task) -> ``stack`` to 4 rows.
The two window functions then run over those 4 rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens import config as C
from sessionlens.functions import safe_pct

_REACHED = ("viewed_item", "added_to_cart", "began_checkout", "purchased")
_SESSION_FLAGS = ("did_view_item", "did_add_to_cart", "did_begin_checkout", "did_purchase")


def funnel_per_user(sessions: DataFrame) -> DataFrame:
    """A user reaches a step if any of their sessions has it, in any order."""
    return sessions.groupBy("user_pseudo_id").agg(
        *[F.bool_or(s).alias(r) for s, r in zip(_SESSION_FLAGS, _REACHED)]
    )


def funnel_counts(sessions: DataFrame) -> DataFrame:
    """One row: users reaching each step (s1..s4)."""
    per_user = funnel_per_user(sessions)
    return per_user.agg(*[F.count_if(r).alias(f"s{i}") for i, r in enumerate(_REACHED, 1)])


def funnel_steps(sessions: DataFrame) -> DataFrame:
    """The four counts unpivoted to (step_order, step, users)."""
    counts = funnel_counts(sessions)
    stack_args = []
    for order, label in C.FUNNEL_STEPS:
        stack_args += [F.lit(order), F.lit(label), F.col(f"s{order}")]
    return counts.select(F.stack(F.lit(len(C.FUNNEL_STEPS)), *stack_args).alias("step_order", "step", "users"))


def funnel_conversion(sessions: DataFrame) -> DataFrame:
    steps = funnel_steps(sessions)
    whole = Window.partitionBy()  # 4 rows
    ordered = Window.orderBy("step_order")
    return steps.select(
        "step_order",
        "step",
        "users",
        # Share of the largest step (not of step 1).
        safe_pct(F.col("users"), F.max("users").over(whole)).alias("pct_of_top"),
        safe_pct(F.col("users"), F.lag("users").over(ordered)).alias("pct_of_previous_step"),
    ).orderBy("step_order")
