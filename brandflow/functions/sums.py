"""Sums of doubles: plain, and exact ones that don't depend on the order of the rows.

``exact_sum`` cuts each value into four integer limbs of 30 bits on a fixed grid
(units of 2^30, 1, 2^-30 and 2^-60). The cuts are exact in double arithmetic, since
scaling by powers of two and taking off the whole part lose nothing; only what lies
below 2^-60 is cut off, the same way for a value wherever it lies. Limbs are
summed as 64-bit integers, which any order and any partitioning sums alike, in the
ordinary partial aggregates. At the end the four sums, which are exact, become one
double again; its error is that of a few additions, however many rows there were.

Up to 2^33 values of a group, each below 2^60 in size, can't overflow. Values that
are larger, infinite or NaN are summed as doubles beside the limbs: they keep the
meaning they have in ``SUM``, but not the independence of order.

The argument occurs many times in the limbs: let it be a column, computed in a
``select`` before, and not a long expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from .expr import col_

#: A sum of a column, as an aggregate or, with a window, over it.
Sum = Callable[..., Column]

BITS = 30
LARGEST = 2.0 ** (2 * BITS)


def _summed(x: Column, over: WindowSpec | None) -> Column:
    total = F.sum(x)
    return total if over is None else total.over(over)


def plain_sum(x: Column | str, over: WindowSpec | None = None) -> Column:
    """``SUM(x)``; its last bits depend on the order of the rows."""
    return _summed(col_(x), over)


def exact_sum(x: Column | str, over: WindowSpec | None = None) -> Column:
    """``SUM(x)`` of doubles, bit for bit the same for any order of the rows; NULL where ``SUM`` is.

    Takes the place of ``F.sum`` in ``agg``, or of ``F.sum(..).over(window)``.
    """
    x = col_(x)
    ordinary = F.abs(x) < F.lit(LARGEST)  # false for NaN, which sorts above all numbers
    r = F.when(ordinary, x)
    step = F.lit(1 << BITS)
    whole = r.cast("long")  # casts go towards zero
    high = (r * F.lit(2.0**-BITS)).cast("long")
    fraction = r - whole.cast("double")
    upper, lower = (fraction * F.lit(2.0**BITS)).cast("long"), (fraction * F.lit(LARGEST)).cast("long")
    limbs = [lower - upper * step, upper, whole - high * step, high]
    units = [2.0 ** (-2 * BITS), 2.0**-BITS, 1.0, 2.0**BITS]
    terms = [_summed(limb, over).cast("double") * F.lit(unit) for limb, unit in zip(limbs, units)]
    value = terms[0] + terms[1] + terms[2] + terms[3]
    beyond = _summed(F.when(~ordinary, x), over)
    return F.coalesce(value + beyond, value, beyond)
