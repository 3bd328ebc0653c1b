"""Calendar features (day name, weekend flag, month, paycheck distances)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, fmt: str = DATE_FORMAT) -> Column:
    """Parse ``yyyy-MM-dd`` strings (dates and timestamps are cast)."""
    return F.to_date(_c(c), fmt)


def day_name(c) -> Column:
    """Full English day name, e.g. ``Monday``."""
    return F.date_format(_c(c), "EEEE")


def is_weekend(c) -> Column:
    """Saturday or Sunday (``dayofweek`` is 1 = Sunday ... 7 = Saturday)."""
    return F.dayofweek(_c(c)).isin(1, 7)


def days_since_15th(c) -> Column:
    """Days since the most recent 15th (0 on the 15th itself)."""
    d = _c(c)
    day = F.dayofmonth(d)
    prev_month_len = F.dayofmonth(F.last_day(F.add_months(F.trunc(d, "month"), -1)))
    return F.when(day >= 15, day - 15).otherwise(prev_month_len - 15 + day).cast("int")


def days_since_last(c, fix_month_end: bool = False) -> Column:
    """Days since the last month-end pay day.

    The workload treats the *penultimate* day of the month as the pay day: it
    scores 0, and the true last day scores its day-of-month.  Pass
    ``fix_month_end=True`` to score the true last day as 0 instead.
    """
    d = _c(c)
    day = F.dayofmonth(d)
    month_len = F.dayofmonth(F.last_day(d))
    payday = month_len if fix_month_end else month_len - 1
    return F.when(day == payday, F.lit(0)).otherwise(day).cast("int")


def days_since_paycheck(c, fix_month_end: bool = False) -> Column:
    return F.least(days_since_15th(c), days_since_last(c, fix_month_end)).cast("int")
