"""Household totals, common spend (cseg) and its allocation to brands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import Sum, least_strict, plain_sum, ratio_or_zero


def household_cseg(spent: DataFrame, *, total: Sum = plain_sum) -> DataFrame:
    """Per household, total spend per period and ``cseg = LEAST(T1, T2)``."""
    return spent.groupBy("hhkey").agg(
        total("spent_p1").alias("total_spent_p1"), total("spent_p2").alias("total_spent_p2")
    ).withColumn("cseg", least_strict("total_spent_p1", "total_spent_p2"))


def _allocate(df: DataFrame) -> DataFrame:
    return df.select(
        "hhkey",
        "brand",
        "spent_p1",
        "spent_p2",
        (F.col("spent_p1") * ratio_or_zero("cseg", "total_spent_p1")).alias("cseg_p1"),
        (F.col("spent_p2") * ratio_or_zero("cseg", "total_spent_p2")).alias("cseg_p2"),
        "cseg",
    )


def cseg_allocation_join(spent: DataFrame, sums: DataFrame | None = None, *, total: Sum = plain_sum) -> DataFrame:
    """Share each brand's spend of the household's cseg, by joining C7 back.

    Both sides come from ``spent`` keyed by ``hhkey``; once ``spent`` is
    hash-partitioned on ``hhkey`` the group and the join need no new shuffle.
    """
    sums = household_cseg(spent, total=total) if sums is None else sums
    return _allocate(spent.join(sums, "hhkey"))


def cseg_allocation_window(spent: DataFrame, *, total: Sum = plain_sum) -> DataFrame:
    """The same allocation with ``SUM(..) OVER (PARTITION BY hhkey)``.

    A household has at most one row per bucket here, so a window partition is
    bounded by the number of buckets whatever the household's purchase count.
    """
    w = Window.partitionBy("hhkey")
    t = spent.select(
        "hhkey",
        "brand",
        "spent_p1",
        "spent_p2",
        total("spent_p1", w).alias("total_spent_p1"),
        total("spent_p2", w).alias("total_spent_p2"),
    ).withColumn("cseg", least_strict("total_spent_p1", "total_spent_p2"))
    return _allocate(t)
