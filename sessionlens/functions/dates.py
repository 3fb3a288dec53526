"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionlens.functions.numeric import int_div


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def micros_to_ts(col: str | Column) -> Column:
    """Epoch microseconds to a timestamp."""
    return F.timestamp_micros(_c(col))


def parse_event_day(col: str | Column) -> Column:
    """A ``yyyyMMdd`` string to a date; bad input raises under ANSI mode, as
    the reference's strict parse does."""
    return F.to_date(_c(col), "yyyyMMdd")


def week_start(col: str | Column) -> Column:
    """The Monday on or before the date."""
    return F.trunc(_c(col), "week")


def week_start_iso(col: str | Column) -> Column:
    """Same Monday, by arithmetic on the ISO weekday (0 = Monday)."""
    return F.date_sub(_c(col), F.weekday(_c(col)))


def weeks_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole weeks between two dates, as a long."""
    return int_div(F.datediff(_c(later), _c(earlier)), 7)


def days_since(as_of: str, col: str | Column) -> Column:
    """Days from ``col`` to the fixed date ``as_of`` (ISO string), as a long."""
    return F.datediff(F.to_date(F.lit(as_of)), _c(col)).cast("long")
