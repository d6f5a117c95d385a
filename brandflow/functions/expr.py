"""Scalar column expressions shared by every stage.

All of them are plain ``pyspark.sql.functions`` compositions, so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default analysis periods of the reference scripts
# (period 1 = calendar 2019, period 2 = calendar 2020), and the bucket name
# given to purchases whose brand is NULL or not in the brand map.
DEFAULT_START_P1 = dt.date(2019, 1, 1)
DEFAULT_END_P1 = dt.date(2019, 12, 31)
DEFAULT_START_P2 = dt.date(2020, 1, 1)
DEFAULT_END_P2 = dt.date(2020, 12, 31)
REST_BUCKET = "REST"

_INF = float("inf")


@dataclass(frozen=True)
class Periods:
    """Two inclusive date ranges; a date in both counts in period 1."""

    start_p1: dt.date = DEFAULT_START_P1
    end_p1: dt.date = DEFAULT_END_P1
    start_p2: dt.date = DEFAULT_START_P2
    end_p2: dt.date = DEFAULT_END_P2

    @classmethod
    def years(cls, y1: int, y2: int) -> "Periods":
        return cls(dt.date(y1, 1, 1), dt.date(y1, 12, 31), dt.date(y2, 1, 1), dt.date(y2, 12, 31))

    def overlap(self) -> bool:
        return self.start_p1 <= self.end_p2 and self.start_p2 <= self.end_p1


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """NULL when the divisor is 0 (also 0/0) or the quotient overflows."""
    q = F.try_divide(col_(a), col_(b))
    return F.when(F.abs(q) == F.lit(_INF), F.lit(None).cast("double")).otherwise(q)


def ifnull0(x: Column | str) -> Column:
    return F.coalesce(col_(x), F.lit(0.0))


def ratio_or_zero(a: Column | str, b: Column | str) -> Column:
    """``IFNULL(SAFE_DIVIDE(a, b), 0)``."""
    return ifnull0(safe_divide(a, b))


def least_strict(a: Column | str, b: Column | str) -> Column:
    """Smaller of two values, NULL if either is NULL (Spark's ``least`` skips NULLs)."""
    a, b = col_(a), col_(b)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).otherwise(F.least(a, b))


def in_range(d: Column | str, start: dt.date, end: dt.date) -> Column:
    d = col_(d)
    return (d >= F.lit(start)) & (d <= F.lit(end))


def in_periods(d: Column | str, p: Periods) -> Column:
    """Date filter: in period 1 or in period 2 (pushed to the Parquet scan)."""
    return in_range(d, p.start_p1, p.end_p1) | in_range(d, p.start_p2, p.end_p2)


def _month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def in_month_periods(month: Column | str, p: Periods) -> Column:
    """Month (first day) overlapping period 1 or 2: the partition predicate a date filter implies."""
    return in_range(month, _month_start(p.start_p1), _month_start(p.end_p1)) | in_range(
        month, _month_start(p.start_p2), _month_start(p.end_p2)
    )


def period_of(d: Column | str, p: Periods, *, filtered: bool) -> Column:
    """Period number of a date.

    ``filtered=False``: 1, 2, or 3 for neither (NULL dates too).
    ``filtered=True``: rows are known to lie in one of the two periods, so 1 or 2.
    """
    p1 = in_range(d, p.start_p1, p.end_p1)
    if filtered:
        return F.when(p1, F.lit(1)).otherwise(F.lit(2))
    p2 = in_range(d, p.start_p2, p.end_p2)
    return F.when(p1, F.lit(1)).when(p2, F.lit(2)).otherwise(F.lit(3))


def in_period(period: Column | str, n: int, x: Column | str) -> Column:
    """``CASE WHEN period = n THEN x ELSE 0 END``: spreads a measure over period columns."""
    return F.when(col_(period) == F.lit(n), col_(x)).otherwise(F.lit(0.0))


def parse_yyyymmdd(s: Column | str) -> Column:
    """Parse a ``yyyyMMdd`` string to DATE; a malformed non-NULL string raises.

    Raises whatever the session's ANSI setting is, so a bad date can never turn
    into a silently dropped purchase.
    """
    s = col_(s)
    d = F.try_to_date(s, "yyyyMMdd")
    return F.when(
        s.isNotNull() & d.isNull(),
        F.raise_error(F.concat(F.lit("malformed purchase date: "), s)),
    ).otherwise(d).cast("date")
