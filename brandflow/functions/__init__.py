"""Scalar expressions: safe division, strict LEAST, period assignment, date parsing; sums of doubles."""

from .expr import (
    REST_BUCKET,
    Periods,
    ifnull0,
    in_month_periods,
    in_period,
    in_periods,
    in_range,
    least_strict,
    parse_yyyymmdd,
    period_of,
    ratio_or_zero,
    safe_divide,
)
from .sums import Sum, exact_sum, plain_sum

__all__ = [
    "REST_BUCKET",
    "Periods",
    "Sum",
    "exact_sum",
    "ifnull0",
    "in_month_periods",
    "in_period",
    "in_periods",
    "in_range",
    "least_strict",
    "parse_yyyymmdd",
    "period_of",
    "plain_sum",
    "ratio_or_zero",
    "safe_divide",
]
