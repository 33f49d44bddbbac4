"""Date and time helpers with the source dialect's boundary rules pinned."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(ts) -> Column:
    """``DATE(ts)``."""
    return F.to_date(as_col(ts))


def day_of_week0(d) -> Column:
    """``DAYOFWEEK`` with 0 = Sunday … 6 = Saturday (Spark's is 1 = Sunday)."""
    return F.dayofweek(as_col(d)) - 1


def is_weekend(d) -> Column:
    return day_of_week0(d).isin(0, 6)


def day_name(ts) -> Column:
    """``DAYNAME``: three-letter English name."""
    return F.date_format(as_col(ts), "EEE")


def week_start(ts) -> Column:
    """``DATE_TRUNC('WEEK', x)`` as a date; weeks start on Monday."""
    return F.to_date(F.date_trunc("week", as_col(ts)))


def month_key(d) -> Column:
    """``TO_VARCHAR(d, 'YYYY-MM')``."""
    return F.date_format(as_col(d), "yyyy-MM")


def mmdd(d) -> Column:
    """``TO_VARCHAR(d, 'MMDD')``."""
    return F.date_format(as_col(d), "MMdd")


def days_between(start, end) -> Column:
    """``DATEDIFF(DAY, start, end)``: midnights crossed, so compare the dates."""
    return F.datediff(F.to_date(as_col(end)), F.to_date(as_col(start)))


def minutes_between(start, end) -> Column:
    """``TIMESTAMPDIFF(MINUTE, start, end)``: minute boundaries crossed."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", as_col(start)),
                            F.date_trunc("minute", as_col(end)))


def ts_lit(value) -> Column:
    """A ``timestamp_ntz`` literal from a date or datetime."""
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value).cast("timestamp_ntz")


def date_lit(value) -> Column:
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value).cast("date")


def day_range(day) -> tuple[Column, Column]:
    """Bounds ``[day, day + 1)`` so a per-day filter stays a pushable range."""
    if isinstance(day, dt.datetime):
        day = day.date()
    return ts_lit(day), ts_lit(day + dt.timedelta(days=1))


def on_day(ts, day) -> Column:
    lo, hi = day_range(day)
    c = as_col(ts)
    return (c >= lo) & (c < hi)
