"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Revenue is summed as a decimal with nine places (converted currencies have
# more than cents), so the total does not depend on the order in which partial
# sums meet (a double sum does, in its last bits).
MONEY = "decimal(38,9)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def exact_sum(col: str | Column) -> Column:
    """Order-independent sum of money; NULL when every input is NULL."""
    return F.sum(_c(col).cast(MONEY)).cast("double")


def int_div(num: Column, den: int | Column) -> Column:
    """Integer division truncating toward zero, as a long (SQL ``div``)."""
    den_c = den if isinstance(den, Column) else F.lit(den)
    return F.call_function("div", num, den_c)


def safe_pct(num: str | Column, den: str | Column, digits: int = 1) -> Column:
    """``round(num / den * 100, digits)``, NULL when ``den`` is 0 or NULL."""
    return F.round(F.try_divide(_c(num), _c(den)) * F.lit(100), digits)
