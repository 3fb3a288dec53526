"""Reader for the driver's tables.

The ``events`` table (event_id, ts, user_id, event_type, value, props) has no
nested params and no session id. ``raw_events`` shapes it into the nested
raw-event export (schemas.RAW_EVENT) with a projection only: no shuffle, and
the day window is turned into a range on ``ts`` so it reaches the Parquet scan
as a pushed filter. By fixed rules on the event id it also makes the irregular
events that real exports hold: missing, repeated, undeclared and empty params,
null users and names, attributes that change inside a session, refunds, stray
and sub-cent revenue.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens import config as C

# ---------------------------------------------------------------------------
# Fixed values of the adapter (must match the DuckDB twin in oracle_sql.py).
# ---------------------------------------------------------------------------
# Driver event_type -> export event_name.
EVENT_NAME_OF_TYPE = {
    "view": "view_item",
    "click": "add_to_cart",
    "signup": "begin_checkout",
    "purchase": "purchase",
    "error": "page_view",
}
# Context values, chosen by a function of the two parts of user_pseudo_id.
DEVICE_CATEGORIES = ("desktop", "mobile", "tablet")
COUNTRIES = ("United States", "India", "Canada", "United Kingdom", "France", "Japan")
TRAFFIC = (("organic", "google"), ("(none)", "(direct)"), ("referral", "partner.example"), ("cpc", "google"))
# Browsers per driver user: user_pseudo_id = user_id || '.' || (k mod BROWSERS).
BROWSERS = 10
PAGE_PREFIX = "/p/"
SECOND_PAGE_PREFIX = "/q/"
EXTRA_PARAM = "engagement_time_msec"  # a key that is not declared
# Irregular events, by (divisor, remainder) of event_id: exports hold such rows.
NO_SESSION = (97, 5)  # no session id param
TWO_SESSIONS = (211, 3)  # the session id param twice, the second one day later
TWO_PAGES = (89, 7)  # the page param twice
EXTRA_KEY = (53, 11)  # the undeclared param as well
EMPTY_PARAMS = (101, 13)
NULL_PARAMS = (103, 17)
NULL_USER = (127, 19)
NULL_NAME = (131, 23)
OTHER_DEVICE = (31, 0)  # the next device category
NEGATIVE_REVENUE = (37, 4)  # of a purchase (a refund)
STRAY_REVENUE = (149, 29)  # revenue of an event that is no purchase
STRAY_AMOUNT = 0.004
SUB_CENT = (7, 0.0005)  # a purchase's revenue has (event_id mod 7) * 0.0005 more
PROPS_K_PATTERN = r'"k"\s*:\s*(-?\d+)'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_bounds(start_day: str, end_day: str) -> tuple[datetime, datetime]:
    """[start 00:00, end + 1 day 00:00) for an inclusive yyyyMMdd range."""
    lo = datetime.strptime(start_day, "%Y%m%d")
    hi = datetime.strptime(end_day, "%Y%m%d") + timedelta(days=1)
    return lo, hi


def raw_events(
    spark: SparkSession, sf_dir: str, start_day: str | None = None, end_day: str | None = None
) -> DataFrame:
    """The driver's events as nested raw events (one row per event)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    if start_day is not None and end_day is not None:
        lo, hi = day_bounds(start_day, end_day)
        # Literals typed like the column (timestamp_ntz) keep the filter pushable.
        ev = ev.where(
            (F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
        )
    # props is a one-key JSON object {"k": <int>}; the key is extracted once
    # (a separate projection keeps it from being re-evaluated per use).
    ev = ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.regexp_extract("props", PROPS_K_PATTERN, 1).try_cast("long").alias("k"),
    )
    # One projection written as SQL expressions: the same plan as the Column
    # API, built with a few calls into the JVM instead of hundreds.
    return ev.selectExpr(*_adapter_exprs())


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_array(values) -> str:
    return "array(" + ", ".join(_sql_str(v) for v in values) + ")"


def _is(rule: tuple[int, int]) -> str:
    return f"event_id % {rule[0]} = {rule[1]}"


def _param(key: str, text: str = "cast(null as string)", number: str = "cast(null as bigint)") -> str:
    return f"named_struct('key', {_sql_str(key)}, 'value', named_struct('string_value', {text}, 'int_value', {number}))"


def _params() -> str:
    day = "cast(datediff(to_date(ts), date'1970-01-01') as bigint)"
    page = "concat({}, cast(k as string))"

    def extra(rule: tuple[int, int], param: str) -> str:
        return f"if({_is(rule)}, array({param}), array())"

    session = _param(C.PARAM_SESSION_ID, number=day)
    listed = ", ".join((
        f"if({_is(NO_SESSION)}, array(), array({session}))",
        f"array({_param(C.PARAM_PAGE_LOCATION, page.format(_sql_str(PAGE_PREFIX)))})",
        extra(TWO_SESSIONS, _param(C.PARAM_SESSION_ID, number=f"{day} + 1")),
        extra(TWO_PAGES, _param(C.PARAM_PAGE_LOCATION, page.format(_sql_str(SECOND_PAGE_PREFIX)))),
        extra(EXTRA_KEY, _param(EXTRA_PARAM, number="k")),
    ))
    # An empty array takes its type from the other branch.
    return f"case when {_is(NULL_PARAMS)} then null when {_is(EMPTY_PARAMS)} then array() else concat({listed}) end"


def _adapter_exprs() -> list[str]:
    sub = f"(k % {BROWSERS})"
    names = ", ".join(f"{_sql_str(t)}, {_sql_str(n)}" for t, n in EVENT_NAME_OF_TYPE.items())
    traffic_idx = f"cast((user_id * 3 + {sub}) % {len(TRAFFIC)} as int)"
    traffic = "array(" + ", ".join(
        f"named_struct('medium', {_sql_str(m)}, 'source', {_sql_str(src)})" for m, src in TRAFFIC
    ) + ")"
    # ``get`` counts from 0 and gives NULL for a NULL place.
    device = f"get({_sql_array(DEVICE_CATEGORIES)}, cast((user_id + {sub} + if({_is(OTHER_DEVICE)}, 1, 0)) % {len(DEVICE_CATEGORIES)} as int))"
    revenue = (
        f"case when event_type = 'purchase' and {_is(NEGATIVE_REVENUE)} then -value "
        f"when event_type = 'purchase' then value + (event_id % {SUB_CENT[0]}) * {SUB_CENT[1]}D "
        f"when {_is(STRAY_REVENUE)} then {STRAY_AMOUNT}D end"
    )
    return [
        "event_id",
        "date_format(ts, 'yyyyMMdd') as event_date",
        "unix_micros(cast(ts as timestamp)) as event_timestamp",
        f"if({_is(NULL_NAME)}, null, map({names})[event_type]) as event_name",
        f"if({_is(NULL_USER)}, null, concat(cast(user_id as string), '.', cast({sub} as string))) as user_pseudo_id",
        f"{_params()} as event_params",
        f"named_struct('category', {device}) as device",
        f"named_struct('country', get({_sql_array(COUNTRIES)}, cast(user_id % {len(COUNTRIES)} as int))) as geo",
        f"get({traffic}, {traffic_idx}) as traffic_source",
        f"named_struct('purchase_revenue_in_usd', {revenue}) as ecommerce",
        "case when event_type = 'purchase' then "
        "array(named_struct('item_id', concat('SKU-', cast(k as string)), 'quantity', cast(1 as bigint), "
        "'price_in_usd', value)) "
        "else cast(array() as array<struct<item_id:string,quantity:bigint,price_in_usd:double>>) end as items",
    ]
