"""Numeric policy: money stays DECIMAL through the sums; averages are taken as
``double(sum) / count`` and rounded figures come from exact decimal division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timefn import as_col

MONEY_SUM = "decimal(20,2)"


def mean(sum_col, count_col) -> Column:
    """Average as ``double(sum) / count``; NULL when the count is 0."""
    cnt = as_col(count_col)
    return F.when(cnt > 0, as_col(sum_col).cast("double") / cnt.cast("double"))


def avg(c) -> Column:
    """``AVG(c)`` over non-NULL values, in double."""
    c = as_col(c)
    return mean(F.sum(c), F.count(c))


def exact_ratio(num, den, scale: int = 12) -> Column:
    """``num / den`` in decimal, exact to ``scale`` places (HALF_UP beyond)."""
    d = as_col(den)
    return F.when(d != 0, as_col(num).cast(f"decimal(38,{scale})") / d.cast("decimal(38,0)"))


def round_avg(sum_col, count_col, digits: int) -> Column:
    """``ROUND(AVG(x), digits)`` computed from the exact sum and count."""
    return F.round(exact_ratio(sum_col, count_col), digits)


def js_round2(x) -> Column:
    """``Math.round(x * 100) / 100`` on doubles (half rounds up)."""
    return F.floor(as_col(x) * 100 + 0.5) / 100


def nullif_zero(c) -> Column:
    c = as_col(c)
    return F.when(c != 0, c)
