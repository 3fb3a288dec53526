"""Run parameters and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, replace

__all__ = ["Params", "DEFAULT", "replace"]

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to match.
# ---------------------------------------------------------------------------

# Event names the session rollup looks for.
EV_PAGE_VIEW = "page_view"
EV_VIEW_ITEM = "view_item"
EV_ADD_TO_CART = "add_to_cart"
EV_BEGIN_CHECKOUT = "begin_checkout"
EV_PURCHASE = "purchase"

# Param keys read from event_params, and the typed slot each is read from.
PARAM_SESSION_ID = "ga_session_id"  # int_value
PARAM_PAGE_LOCATION = "page_location"  # string_value

# Funnel steps, in order: (step_order, label).
FUNNEL_STEPS = (
    (1, "View item"),
    (2, "Add to cart"),
    (3, "Begin checkout"),
    (4, "Purchase"),
)

# RFM segment labels.
SEG_CHAMPIONS = "Champions"
SEG_LOYAL = "Loyal"
SEG_NEW = "New / Promising"
SEG_AT_RISK = "At Risk"
SEG_HIBERNATING = "Hibernating"
SEG_NEEDS_ATTENTION = "Needs Attention"
SEGMENTS = (SEG_CHAMPIONS, SEG_LOYAL, SEG_NEW, SEG_AT_RISK, SEG_HIBERNATING, SEG_NEEDS_ATTENTION)

# Check-result statuses that raise an alert, and the owner used when none is set.
ALERT_STATUSES = ("fail", "error", "warn")
UNOWNED = "unowned"

# Model layers that the governance gate covers.
GOVERNED_LAYERS = ("marts", "observability")

# Reference sample window and its as-of date (the day after the window).
REFERENCE_START_DAY = "20201101"
REFERENCE_END_DAY = "20210131"
REFERENCE_AS_OF = "2021-02-01"

# Monitor defaults: flagged-session share and the session-count band.
FLAG_RATE_MAX = 0.02
VOLUME_MIN = 300_000
VOLUME_MAX = 420_000

# Export shard size of the NDJSON interchange files.
EXPORT_SHARD_ROWS = 250_000


@dataclass(frozen=True)
class Params:
    """Parameters of one build. Defaults fit the driver's ``events`` table
    (2024-01-01 .. 2024-01-30): the whole month is read and the as-of date is
    the day after the last day, the same rule the reference uses."""

    start_day: str = "20240101"  # inclusive, yyyyMMdd
    end_day: str = "20240131"  # inclusive, yyyyMMdd
    as_of: str = "2024-01-31"  # recency is measured to this date
    n_tiles: int = 5
    retention_weeks: int = 8
    flag_rate_max: float = FLAG_RATE_MAX
    volume_min: int = VOLUME_MIN
    volume_max: int = VOLUME_MAX
    run_id: str = "run-0001"
    # Quintiles by counting, by a distributed sort, or Spark's one-partition ntile.
    ntile_method: str = "counting"  # counting | distributed | window


DEFAULT = Params()
