"""M2: session rollup, one row per (user, session).

One hash aggregation keyed by (user_pseudo_id, ga_session_id). Every
aggregate is partial-aggregatable, so a hot session is collapsed map-side and
the shuffle carries at most one row per session per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens import config as C
from sessionlens.functions.numeric import MONEY


def any_value(col: str) -> Column:
    """Deterministic ``any_value``: the smallest non-NULL value. (``min`` is
    partial-aggregatable and cheaper than ``min_by`` over a struct order.)"""
    return F.min(col)


def _is(name: str) -> Column:
    return F.col("event_name") == F.lit(name)


def session_key(user: str | Column = "user_pseudo_id", sid: str | Column = "ga_session_id") -> Column:
    """user || '-' || session id; NULL if either part is NULL (``concat``)."""
    u = F.col(user) if isinstance(user, str) else user
    s = F.col(sid) if isinstance(sid, str) else sid
    return F.concat(u, F.lit("-"), s.cast("string"))


_KEYS = ("user_pseudo_id", "ga_session_id")
_ATTRS = ("device_category", "country", "traffic_medium")


def _measures() -> list[Column]:
    """The aggregates that need no attribute; every buffer is fixed-width."""
    return [
        F.min("event_ts").alias("session_start"),
        F.max("event_ts").alias("session_end"),
        # The export's own day, not a truncation of the timestamp.
        F.min("event_date").alias("session_date"),
        F.count_if(_is(C.EV_PAGE_VIEW)).alias("page_views"),
        F.count_if(_is(C.EV_VIEW_ITEM)).alias("view_item_events"),
        F.bool_or(_is(C.EV_VIEW_ITEM)).alias("did_view_item"),
        F.bool_or(_is(C.EV_ADD_TO_CART)).alias("did_add_to_cart"),
        F.bool_or(_is(C.EV_BEGIN_CHECKOUT)).alias("did_begin_checkout"),
        F.bool_or(_is(C.EV_PURCHASE)).alias("did_purchase"),
        # NULL, not 0, for sessions without revenue.
        F.sum(F.col("purchase_revenue_usd").cast(MONEY)).alias("revenue"),
    ]


def session_core(staged: DataFrame) -> DataFrame:
    """Sessions without their attributes, for the marts that use none: one
    hash aggregation, one shuffle, no string but the user in its key."""
    core = staged.groupBy(*_KEYS).agg(*_measures())
    return core.withColumn("session_key", session_key()).withColumn("revenue_usd", F.col("revenue").cast("double")).drop("revenue")


def build_sessions(staged: DataFrame) -> DataFrame:
    """Two aggregation levels, both hash-based:

    1. by (user, session, device, country, medium): the strings are grouping
       keys, so every aggregation buffer is fixed-width and Spark plans a
       HashAggregate with map-side combine over the raw events;
    2. by (user, session): folds the (normally single) attribute combination
       per session. Only this step holds strings in buffers (a sort-based
       aggregate), and it runs over session-level rows, not events.

    min/max/sum/count/bool_or are all decomposable, so the result equals one
    aggregation over the events."""
    level1 = staged.groupBy(*_KEYS, *_ATTRS).agg(*_measures())
    agg = level1.groupBy(*_KEYS).agg(
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.min("session_date").alias("session_date"),
        *[any_value(a).alias(a) for a in _ATTRS],
        F.sum("page_views").alias("page_views"),
        F.sum("view_item_events").alias("view_item_events"),
        *[F.bool_or(c).alias(c) for c in ("did_view_item", "did_add_to_cart", "did_begin_checkout", "did_purchase")],
        F.sum("revenue").cast("double").alias("revenue_usd"),
    )
    return agg.select(
        "user_pseudo_id",
        "ga_session_id",
        session_key().alias("session_key"),
        "session_start",
        "session_end",
        "session_date",
        "device_category",
        "country",
        "traffic_medium",
        "page_views",
        "view_item_events",
        "did_view_item",
        "did_add_to_cart",
        "did_begin_checkout",
        "did_purchase",
        "revenue_usd",
    )


def session_attributes(staged: DataFrame) -> DataFrame:
    """The three any_value columns per session, on their own. The events are
    first counted per combination (a hash aggregation with map-side combine),
    so the string minimum sees session-level rows only. The count is carried
    through because the optimizer would remove a plain distinct below a
    minimum and sort the events instead."""
    combinations = staged.groupBy(*_KEYS, *_ATTRS).agg(F.count(F.lit(1)).alias("n"))
    folded = combinations.groupBy(*_KEYS).agg(*[any_value(a).alias(a) for a in _ATTRS], F.sum("n").alias("n"))
    return folded.where(F.col("n") > 0).drop("n")
