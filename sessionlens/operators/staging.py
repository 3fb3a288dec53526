"""M1: flatten and type raw events; drop rows without a session id.

Two forms of the param lookup exist in the reference's two dialects:

* ``stage_events``: keyed lookup by position in the array of keys
  (``array_position`` + ``get``; a projection in generated code, no unnest,
  no join, no shuffle). This is the production path.
* ``flatten_params``: the second dialect's unnest, grouping by every event
  column and conditional max. It differs where a key repeats (largest value
  instead of the first). The grouping is done inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens import config as C
from sessionlens.functions import micros_to_ts, param_key_count, param_value, parse_event_day


def in_day_window(raw: DataFrame, start_day: str, end_day: str, day_col: str = "event_date") -> DataFrame:
    """Inclusive string range on the day shard. On a day-partitioned dataset
    (``day_col`` = the partition column) this prunes whole directories."""
    return raw.where(F.col(day_col).between(F.lit(start_day), F.lit(end_day)))


def stage_events(
    raw: DataFrame, start_day: str | None = None, end_day: str | None = None, day_col: str = "event_date"
) -> DataFrame:
    """Raw events -> one typed row per event that carries a session id."""
    src = in_day_window(raw, start_day, end_day, day_col) if start_day and end_day else raw
    staged = src.select(
        F.col("user_pseudo_id"),
        param_value(C.PARAM_SESSION_ID, "int_value").alias("ga_session_id"),
        F.col("event_name"),
        micros_to_ts("event_timestamp").alias("event_ts"),
        parse_event_day("event_date").alias("event_date"),
        param_value(C.PARAM_PAGE_LOCATION, "string_value").alias("page_location"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_usd"),
    )
    # The lookup is computed once, under its alias, and filtered on.
    return staged.where(F.col("ga_session_id").isNotNull())


def null_session_events(raw: DataFrame) -> DataFrame:
    """Raw events the staging guard drops (no int session id)."""
    return raw.where(param_value(C.PARAM_SESSION_ID, "int_value").isNull())


def duplicate_param_keys(raw: DataFrame, keys: tuple[str, ...] = (C.PARAM_SESSION_ID, C.PARAM_PAGE_LOCATION)) -> DataFrame:
    """Events in which a looked-up key occurs more than once. The reference's
    scalar subquery raises on these; the staging keeps the first, and this
    check reports them."""
    counted = raw.select(
        "event_id",
        "user_pseudo_id",
        "event_date",
        *[param_key_count(k).alias(f"n_{k}") for k in keys],
    )
    cond = None
    for k in keys:
        c = F.col(f"n_{k}") > 1
        cond = c if cond is None else (cond | c)
    return counted.where(cond)


def duplicate_param_key_events(raw: DataFrame, keys: tuple[str, ...] = (C.PARAM_SESSION_ID, C.PARAM_PAGE_LOCATION)) -> DataFrame:
    """The number of rows of ``duplicate_param_keys``, as ``failures``. The
    condition is counted in the aggregate, where Spark computes the params of
    an event once; a filter on it computes them anew for each use."""
    most = F.greatest(F.lit(0), *[param_key_count(k) for k in keys])
    return raw.agg(F.count_if(most > 1).alias("failures"))


def _largest(key: str, slot: str) -> Column:
    """The largest value of a key's slot in one event's params: what a
    conditional max over the event's exploded params gives."""
    own = F.filter("event_params", lambda p: p["key"] == key)
    return F.array_max(F.transform(own, lambda p: p["value"][slot]))


def flatten_params(raw: DataFrame, start_day: str | None = None, end_day: str | None = None) -> DataFrame:
    """Second-dialect staging: the params unnested (inner: an empty or NULL
    array drops the event), two keys pivoted back with a conditional max, one
    row per event. All params of an event are in its row, so the grouping
    happens there and no event is shuffled."""
    src = in_day_window(raw, start_day, end_day) if start_day and end_day else raw
    params = src.where(F.size("event_params") > 0).select(
        "event_id",
        "user_pseudo_id",
        _largest(C.PARAM_SESSION_ID, "int_value").alias("ga_session_id"),
        "event_name",
        micros_to_ts("event_timestamp").alias("event_ts"),
        parse_event_day("event_date").alias("event_date"),
        _largest(C.PARAM_PAGE_LOCATION, "string_value").alias("page_location"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_usd"),
    )
    return params.where(F.col("ga_session_id").isNotNull())
