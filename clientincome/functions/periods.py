"""Period (int yyyyMM) arithmetic as column expressions.

Periods are plain integers.  The hot path stays in integer arithmetic (one
codegen'd expression, no per-row string parsing); the date-based forms exist
for callers that start from dates, and ``period_math`` checks that both agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def months_of(start: int, end: int) -> list[int]:
    """The yyyyMM periods from ``start`` to ``end``, both included."""
    first, last = (p // 100 * 12 + p % 100 - 1 for p in (start, end))
    return [m // 12 * 100 + m % 12 + 1 for m in range(first, last + 1)]


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def period_index(period) -> Column:
    """Months since year 0 for a yyyyMM column: 200012 -> 2000*12 + 11."""
    p = _c(period)
    return (F.floor(p / 100) * 12 + (p % 100) - 1).cast("int")


def month_diff(later, earlier) -> Column:
    """Whole months from ``earlier`` to ``later`` (both yyyyMM)."""
    return period_index(later) - period_index(earlier)


def recency(ref_period, period) -> Column:
    """Months back from the reference month, counting the month itself as 1."""
    return month_diff(ref_period, period) + F.lit(1)


def period_to_date(period) -> Column:
    """yyyyMM -> first day of that month (``to_date`` of ``yyyyMMdd``)."""
    return F.to_date((_c(period) * 100 + 1).cast("string"), "yyyyMMdd")


def period_to_timestamp(period) -> Column:
    return F.to_timestamp((_c(period) * 100 + 1).cast("string"), "yyyyMMdd")


def date_to_period(d) -> Column:
    """Date -> yyyyMM int via ``date_format`` (the formatted-string form)."""
    return F.date_format(_c(d), "yyyyMM").cast("int")


def period_of_date(d) -> Column:
    """Date -> yyyyMM int via year/month (portable form)."""
    d = _c(d)
    return F.year(d) * 100 + F.month(d)


def add_months_period(period, n: int) -> Column:
    """yyyyMM shifted by ``n`` months, through ``add_months`` on dates."""
    return date_to_period(F.add_months(period_to_date(period), n))


def age_years(ref_period: int, birth) -> Column:
    """Age as ``round(months_between(first of ref month, birth) / 12)`` int."""
    first = F.to_date(F.lit(f"{int(ref_period)}01"), "yyyyMMdd")
    return F.round(F.months_between(first, _c(birth)) / 12, 0).cast("int")
