"""Spend per (household, brand) and the continuous-sample weighting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import Sum, in_period, plain_sum


def _row_measures(classified: DataFrame):
    """(continuous-sample base, full-sample value) of one classified row."""
    cols = classified.columns
    if "spent_cs" in cols:
        return F.col("spent_cs"), F.col("spent_fs")
    base = F.col("value") * F.col("brandfactor") if "brandfactor" in cols else F.col("value")
    return base, base * F.col("rwkorr") * F.col("rwstd") * F.col("fullmasW")


def spend_by_household_brand(classified: DataFrame, *, two_level: bool = False, total: Sum = plain_sum) -> DataFrame:
    """Per (household, brand): spend in period 1 and 2, continuous and full sample.

    Output: ``hhkey, brand, spent_p1_ics, spent_p2_ics, spent_p1_fs, spent_p2_fs``
    (``spent_p1_cs, spent_p2_cs, ...`` for pre-weighted input, which already
    carries the household weight).

    ``two_level=False`` spreads each row over the period columns before one
    ``SUM`` per (household, brand); partial aggregation runs map-side, so a
    household holding a huge share of the rows still leaves each task as at
    most one row per bucket. ``two_level=True`` sums per (household, brand,
    period) first and then collapses the periods: same result (a period sum
    that is NULL meets zeros from the other periods exactly as NULL rows would),
    one more shuffle.

    ``total`` is the sum to use, here and in every other stage: ``exact_sum`` makes the
    result independent of the order and the partitioning of the rows.
    """
    base, fs = _row_measures(classified)
    cs_name = "cs" if "spent_cs" in classified.columns else "ics"
    names = [f"spent_p1_{cs_name}", f"spent_p2_{cs_name}", "spent_p1_fs", "spent_p2_fs"]
    if not two_level:
        measures = [in_period("period", n, x) for x in (base, fs) for n in (1, 2)]
        rows = classified.select("hhkey", "brand", *[x.alias(name) for x, name in zip(measures, names)])
    else:
        rows = classified.select("hhkey", "brand", "period", base.alias("_cs"), fs.alias("_fs"))
        by_period = rows.groupBy("hhkey", "brand", "period").agg(total("_cs").alias("_cs"), total("_fs").alias("_fs"))
        measures = [in_period("period", n, x) for x in ("_cs", "_fs") for n in (1, 2)]
        # by household: the second sum, the household join and the write of C3 then need no shuffle of their own
        rows = by_period.repartition("hhkey").select("hhkey", "brand", *[x.alias(name) for x, name in zip(measures, names)])
    return rows.groupBy("hhkey", "brand").agg(*[total(name).alias(name) for name in names])


def household_weights(households: DataFrame, *, total: Sum = plain_sum) -> DataFrame:
    """One row per household: copies, summed weight, copies with a non-zero weight.

    The household table is not declared unique; joining it as it is would
    multiply every (household, brand) row by the number of copies and put all
    of them into one window partition later. Every downstream quantity is a
    sum over copies, so the copies are folded here, before any join:
    ``continuo`` = SUM(continuo) (NULL copies skipped), ``n_copies`` = COUNT(*),
    ``n_active`` = copies with ``continuo != 0``.
    """
    return households.groupBy("hhkey").agg(
        F.count(F.lit(1)).alias("n_copies"),
        total("continuo").alias("continuo"),
        F.count(F.when(F.col("continuo") != 0, F.lit(1))).alias("n_active"),
    )


def continuous_sample(
    spend: DataFrame, households: DataFrame, *, by_household: bool = False, total: Sum = plain_sum
) -> DataFrame:
    """Apply the household weight; households missing from the table drop out.

    Output: ``hhkey, brand, spent_p1_cs, spent_p2_cs, spent_p1_fs, spent_p2_fs``
    plus ``spent_p1_ics, spent_p2_ics, n_active`` for the zero-spend filter of C6.
    The full-sample values count once per household copy.

    ``by_household=True`` makes the join a shuffle join on ``hhkey``, so the
    output is hash-partitioned by household (for a write bucketed by it).
    """
    hh = household_weights(households, total=total)
    j = spend.join(hh.hint("merge") if by_household else hh, "hhkey")
    return j.select(
        "hhkey",
        "brand",
        (F.col("spent_p1_ics") * F.col("continuo")).alias("spent_p1_cs"),
        (F.col("spent_p2_ics") * F.col("continuo")).alias("spent_p2_cs"),
        (F.col("spent_p1_fs") * F.col("n_copies")).alias("spent_p1_fs"),
        (F.col("spent_p2_fs") * F.col("n_copies")).alias("spent_p2_fs"),
        "spent_p1_ics",
        "spent_p2_ics",
        "n_active",
    )
