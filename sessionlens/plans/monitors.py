"""Monitors learned from the data itself.

* ``daily_volume_anomaly``: daily session counts against the median and the
  median absolute deviation of the same weekday, on a full calendar of the
  window. The windows run over one row per day (bounded by the calendar, not by
  the data).
* ``freshness_check``: age of the newest session at the end of each day against
  the quantile of its history.
* ``schema_drift``: the param keys actually present in the semi-structured
  ``event_params`` against the declared ones; ``field_drift``: the leaf fields
  of landed files against the declared raw schema.
* ``build_reconciliation``: two builds of the same model compared row for
  row in one grouping.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens import config as C


# How a day's history is chosen: the same weekday in the weeks before if there
# are enough of them, else the days just before.
WEEKS, LEAST_WEEKS = 8, 3
DAYS, LEAST_DAYS = 14, 7
MAD_TO_SIGMA = 1.4826  # of a normal distribution


def _daily(sessions: DataFrame, start_day: str, end_day: str, *figures) -> DataFrame:
    """One row for each day of the window (yyyyMMdd, inclusive), also for days
    without sessions."""
    first, last = (F.to_date(F.lit(d), "yyyyMMdd") for d in (start_day, end_day))
    calendar = sessions.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("session_date"))
    # Both sides have one row per day.
    return calendar.join(sessions.groupBy("session_date").agg(*figures), "session_date", "left")


def _with_history(daily: DataFrame, value: str) -> DataFrame:
    """Adds ``past``, the values of the day's history (null without enough),
    and ``basis``: weekday, recent or none. Windows over a row per day."""
    by_day = Window.partitionBy(F.weekday("session_date")).orderBy("session_date").rowsBetween(-WEEKS, -1)
    before = Window.orderBy("session_date").rowsBetween(-DAYS, -1)
    same, recent = F.collect_list(value).over(by_day), F.collect_list(value).over(before)
    both = daily.withColumns({"same": same, "recent": recent})
    basis = F.when(F.size("same") >= LEAST_WEEKS, "weekday").when(F.size("recent") >= LEAST_DAYS, "recent").otherwise("none")
    past = F.when(F.size("same") >= LEAST_WEEKS, F.col("same")).when(F.size("recent") >= LEAST_DAYS, F.col("recent"))
    return both.withColumns({"basis": basis, "past": F.array_sort(past)}).drop("same", "recent")


def _quantile(ordered: Column, q: float) -> Column:
    """Interpolated quantile of a sorted array, null for null."""
    at = F.lit(q) * (F.size(ordered) - 1)
    low = F.floor(at).cast("int")
    below, above = F.get(ordered, low), F.get(ordered, F.ceil(at).cast("int"))
    return F.when(ordered.isNotNull(), below + (above - below) * (at - low))


def daily_volume_anomaly(
    sessions: DataFrame, start_day: str, end_day: str, z_max: float = 3.0, least_share: float = 0.05, least_spread: float = 1.0
) -> DataFrame:
    """Daily session counts against their own history: the median of the same
    weekday (or of the days before), and the median absolute deviation from it,
    which a single odd day in the history does not move. The spread is never
    taken below ``least_share`` of the median nor ``least_spread``, so a history
    without spread finds anomalies too. A day without sessions always is one."""
    daily = _daily(sessions, start_day, end_day, F.count(F.lit(1)).alias("n"))
    daily = daily.select("session_date", F.coalesce("n", F.lit(0)).alias("sessions"))
    known = _with_history(daily, "sessions")
    known = known.withColumn("expected", _quantile(F.col("past"), 0.5))
    off = F.array_sort(F.transform("past", lambda x: F.abs(x - F.col("expected"))))
    floor = F.greatest(F.lit(least_share) * F.col("expected"), F.lit(least_spread))
    known = known.withColumn("spread", F.greatest(F.lit(MAD_TO_SIGMA) * _quantile(off, 0.5), floor))
    known = known.withColumn("score", (F.col("sessions") - F.col("expected")) / F.col("spread"))
    far = F.coalesce(F.abs("score") > z_max, F.lit(False))
    return known.select(
        "session_date", "sessions", "basis", F.coalesce(F.size("past"), F.lit(0)).cast("long").alias("history_days"),
        *[F.when(F.col("expected").isNotNull(), F.round(c, 6)).alias(c) for c in ("expected", "spread", "score")],
        (far | (F.col("sessions") == 0)).alias("is_anomaly"),
    )


def freshness_check(
    sessions: DataFrame, start_day: str, end_day: str, run_time: str, quantile: float = 0.95, slack: float = 1.5, least_hours: float = 1.0
) -> DataFrame:
    """For each day that was over at ``run_time`` ('yyyy-MM-dd HH:mm:ss', UTC):
    how long before its end the newest session had started, against what the
    day's history leads to expect (its ``quantile``, with ``slack``). A gap that
    comes every week is usual; the same gap on another day is stale."""
    per_day = _daily(sessions, start_day, end_day, F.max("session_start").alias("latest_session_start"))
    end = F.to_timestamp(F.date_add("session_date", 1))
    per_day = per_day.where(end <= F.to_timestamp(F.lit(run_time)))
    so_far = Window.orderBy("session_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row per day
    seen = per_day.withColumn("newest_session_start", F.max("latest_session_start").over(so_far))
    lag = (F.unix_micros(end) - F.unix_micros("newest_session_start")) / F.lit(3.6e9)
    known = _with_history(seen.withColumn("lag_hours", lag), "lag_hours")
    known = known.withColumn("usual_lag_hours", _quantile(F.col("past"), quantile))
    limit = F.when(F.col("past").isNotNull(), F.greatest(F.lit(slack) * F.col("usual_lag_hours"), F.lit(least_hours)))
    known = known.withColumn("limit_hours", limit)
    return known.select(
        "session_date", "latest_session_start", "newest_session_start", "basis",
        *[F.round(c, 6).alias(c) for c in ("lag_hours", "usual_lag_hours", "limit_hours")],
        F.coalesce(F.col("lag_hours") > F.col("limit_hours"), F.lit(False)).alias("is_stale"),
    )


def param_key_drift(raw: DataFrame, declared=(C.PARAM_SESSION_ID, C.PARAM_PAGE_LOCATION)) -> DataFrame:
    """Param keys of the data and of the declaration with their event-param
    counts: ``ok``, ``new_key`` (not declared) or ``missing`` (declared, not
    in the data)."""
    keys = raw.select(F.explode("event_params.key").alias("param_key"))
    counts = keys.groupBy("param_key").agg(F.count(F.lit(1)).alias("events"))
    known = raw.sparkSession.createDataFrame([(k,) for k in declared], "declared_key string")
    both = counts.join(known, counts["param_key"] == known["declared_key"], "full_outer")
    return both.select(
        F.coalesce("param_key", "declared_key").alias("param_key"),
        F.coalesce("events", F.lit(0)).alias("events"),
        F.col("declared_key").isNotNull().alias("declared"),
        F.when(F.col("declared_key").isNull(), F.lit("new_key")).when(F.col("events").isNull(), F.lit("missing")).otherwise(F.lit("ok")).alias("status"),
    )


def leaves(schema: T.DataType, prefix: str = "") -> dict[str, str]:
    """Leaf paths of a schema with their types; ``[]`` marks an array's element."""
    if isinstance(schema, T.StructType):
        out: dict[str, str] = {}
        for f in schema.fields:
            out |= leaves(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
        return out
    if isinstance(schema, T.ArrayType):
        return leaves(schema.elementType, f"{prefix}[]")
    return {prefix: schema.simpleString()}


def field_drift(observed: T.StructType, declared: T.StructType) -> list[tuple[str, str | None, str | None, str]]:
    """Leaf fields, nested ones by their path: (field, declared type, observed
    type, status)."""
    obs, dec = leaves(observed), leaves(declared)
    out = []
    for name in sorted(set(obs) | set(dec)):
        d, o = dec.get(name), obs.get(name)
        status = "ok" if d == o else ("added" if d is None else ("removed" if o is None else "type_changed"))
        out.append((name, d, o, status))
    return out


def build_reconciliation(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts and multiset differences of two builds of one model. Both
    sides meet in one grouping by all columns that counts each side's copies,
    so each build runs once."""
    cols = left.columns
    left_side, right_side = ((F.lit(n).cast("long") for n in pair) for pair in ((1, 0), (0, 1)))
    names = ("in_left", "in_right")
    both = left.select(*cols, *[c.alias(n) for c, n in zip(left_side, names)]).unionByName(
        right.select(*cols, *[c.alias(n) for c, n in zip(right_side, names)])
    )
    rows = both.groupBy(*cols).agg(*[F.sum(n).alias(n) for n in names])
    zero, (a, b) = F.lit(0).cast("long"), (F.col(n) for n in names)
    out = rows.agg(
        F.coalesce(F.sum(a), zero).alias("left_rows"),
        F.coalesce(F.sum(b), zero).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(a - b, zero)), zero).alias("only_left"),
        F.coalesce(F.sum(F.greatest(b - a, zero)), zero).alias("only_right"),
    )
    return out.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def run_time_after(as_of: str) -> str:
    """Midnight of the as-of date, as the run time of a freshness check."""
    return datetime.strptime(as_of, "%Y-%m-%d").strftime("%Y-%m-%d %H:%M:%S")
