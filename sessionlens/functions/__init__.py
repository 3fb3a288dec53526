"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage code generation."""

from sessionlens.functions.dates import (
    micros_to_ts,
    parse_event_day,
    week_start,
    week_start_iso,
    weeks_between,
    days_since,
)
from sessionlens.functions.params import param_lookup, param_key_count, param_value
from sessionlens.functions.numeric import exact_sum, int_div, safe_pct

__all__ = [
    "micros_to_ts",
    "parse_event_day",
    "week_start",
    "week_start_iso",
    "weeks_between",
    "days_since",
    "param_lookup",
    "param_key_count",
    "param_value",
    "exact_sum",
    "int_div",
    "safe_pct",
]
