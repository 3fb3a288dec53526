"""M4: weekly acquisition-cohort retention.

The reference joins per-user first week to distinct (user, week) activity.
Here one aggregation keyed by user produces both: the cohort (first active
Monday) and the set of active Mondays. Exploding the set gives each
(user, week) once. Same rows as the join, with one shuffle on user instead of
three, and no per-user table to broadcast.

With a known day window the set is a bitmap: week i of the window is bit
i mod 64 of word i div 64, merged with ``bit_or``. Every aggregation buffer
is then fixed-width, so Spark plans a HashAggregate with map-side combine
(a hot user is collapsed before the shuffle). Without a window the set is a
``collect_set`` (bounded by the number of distinct weeks, but an
object-hash aggregate that turns sort-based on many keys).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions import int_div, week_start, weeks_between

_WORD = 64


def window_weeks(start_day: str, end_day: str) -> tuple[dt.date, int]:
    """First Monday of an inclusive yyyyMMdd window and its number of weeks."""
    a = dt.datetime.strptime(start_day, "%Y%m%d").date()
    z = dt.datetime.strptime(end_day, "%Y%m%d").date()
    first = a - dt.timedelta(days=a.weekday())
    last = z - dt.timedelta(days=z.weekday())
    return first, (last - first).days // 7 + 1


def _bit(words: list[str], idx: Column) -> Column:
    """Whether bit ``idx`` is set; NULL (not set) outside the bitmap."""
    word = F.get(F.array(*[F.col(w) for w in words]), int_div(idx, _WORD).cast("int"))
    return F.call_function("shiftright", word, (idx % _WORD).cast("int")).bitwiseAND(F.lit(1)) == 1


def known_users(sessions: DataFrame) -> DataFrame:
    """Sessions of identified users. The reference joins and counts users by
    their id, so a NULL id is in no cohort (it stays in the funnel and in the
    weekly activity, which only group by it)."""
    return sessions.where(F.col("user_pseudo_id").isNotNull())


def user_week_bitmap(sessions: DataFrame, first_monday: dt.date, n_weeks: int) -> tuple[DataFrame, list[str]]:
    """Per user: index of the first active week and the active-week bitmap
    (one long per 64 weeks). A session outside the window fails the job
    rather than setting a wrong bit."""
    raw_idx = weeks_between(week_start("session_date"), F.lit(first_monday))
    inside = raw_idx.between(0, n_weeks - 1)
    idx = F.coalesce(F.assert_true(inside, "session_date outside the retention window").cast("long"), raw_idx)
    words = [f"w{i}" for i in range(-(-n_weeks // _WORD))]
    bits = [
        F.bit_or(
            F.when(
                int_div(idx, _WORD) == i,
                F.call_function("shiftleft", F.lit(1).cast("long"), (idx % _WORD).cast("int")),
            )
        ).alias(w)
        for i, w in enumerate(words)
    ]
    return known_users(sessions).groupBy("user_pseudo_id").agg(F.min(idx).alias("first_idx"), *bits), words


def _cohort_cells_bitmap(sessions: DataFrame, max_weeks: int, first_monday: dt.date, n_weeks: int) -> DataFrame:
    per_user, words = user_week_bitmap(sessions, first_monday, n_weeks)
    ahead = per_user.select(
        "first_idx", *words, F.explode(F.sequence(F.lit(0), F.lit(max_weeks))).alias("weeks_since")
    )
    active = ahead.where(_bit(words, F.col("first_idx") + F.col("weeks_since")))
    cohort = F.date_add(F.lit(first_monday), (F.col("first_idx") * 7).cast("int"))
    return active.select(cohort.alias("cohort_week"), F.col("weeks_since").cast("long").alias("weeks_since"))


def weekly_activity(sessions: DataFrame) -> DataFrame:
    """Distinct (user, active Monday)."""
    return sessions.select("user_pseudo_id", week_start("session_date").alias("active_week")).distinct()


def user_weeks(sessions: DataFrame) -> DataFrame:
    """Per user: sorted distinct active Mondays; the first is the cohort."""
    weeks = known_users(sessions).select("user_pseudo_id", week_start("session_date").alias("active_week"))
    return weeks.groupBy("user_pseudo_id").agg(F.array_sort(F.collect_set("active_week")).alias("weeks"))


def cohort_activity(sessions: DataFrame, window: tuple[str, str] | None = None) -> DataFrame:
    """(user, cohort_week, active_week, weeks_since) for every active week."""
    if window is not None:
        first_monday, n_weeks = window_weeks(*window)
        per_user, words = user_week_bitmap(sessions, first_monday, n_weeks)
        ahead = per_user.select(
            "user_pseudo_id", "first_idx", *words,
            F.explode(F.sequence(F.col("first_idx"), F.lit(n_weeks - 1).cast("long"))).alias("idx"),
        )
        active = ahead.where(_bit(words, F.col("idx")))
        return active.select(
            "user_pseudo_id",
            F.date_add(F.lit(first_monday), (F.col("first_idx") * 7).cast("int")).alias("cohort_week"),
            F.date_add(F.lit(first_monday), (F.col("idx") * 7).cast("int")).alias("active_week"),
            (F.col("idx") - F.col("first_idx")).alias("weeks_since"),
        )
    per_user = user_weeks(sessions)
    exploded = per_user.select(
        "user_pseudo_id",
        F.element_at("weeks", 1).alias("cohort_week"),
        F.explode("weeks").alias("active_week"),
    )
    return exploded.withColumn("weeks_since", weeks_between("active_week", "cohort_week"))


def retention_cohorts(
    sessions: DataFrame, max_weeks: int = 8, window: tuple[str, str] | None = None
) -> DataFrame:
    """(cohort_week, weeks_since, active_users), weeks 0..max_weeks; empty
    cells are absent rows. ``window`` = the (start_day, end_day) the sessions
    were staged from; it bounds the weeks and enables the bitmap form."""
    if window is not None:
        cells = _cohort_cells_bitmap(sessions, max_weeks, *window_weeks(*window))
    else:
        cells = cohort_activity(sessions).where(F.col("weeks_since").between(0, max_weeks))
    # Each (user, week) occurs once, so count(*) equals count(distinct user).
    return (
        cells.groupBy("cohort_week", "weeks_since")
        .agg(F.count("*").alias("active_users"))
        .orderBy("cohort_week", "weeks_since")
    )
