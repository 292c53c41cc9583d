"""Date scalar functions (inventory I12-I15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dayofweek(c: Column) -> Column:
    """Pandas ``dayofweek``: Monday = 0 (Spark ``dayofweek`` is Sunday = 1)."""
    return F.weekday(c)


def day_name(c: Column) -> Column:
    """``day_name()``: English weekday name."""
    return F.date_format(c, "EEEE")


def to_period_month(c: Column) -> Column:
    """``to_period('M')`` as the month's first day (DATE)."""
    return F.trunc(F.to_date(c), "MM")


def add_months(c: Column, n: int) -> Column:
    """``+ pd.DateOffset(months=n)``: time of day kept, day clipped to the
    month end (S23)."""
    return c + F.make_interval(F.lit(0), F.lit(n))


def format_number(c: Column, decimals: int = 2) -> Column:
    """``'{:.2f}'.format`` as text (Java half-up rounding, see S15/I15)."""
    return F.format_string(f"%.{decimals}f", c)
