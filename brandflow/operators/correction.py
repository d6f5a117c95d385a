"""Correction factors per brand and corrected spend per (household, brand)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import Sum, in_period, plain_sum, ratio_or_zero
from .lookup import MAX_BROADCAST_ROWS, joined_apart, lookup_join
from .spend import household_weights


def correction_factors(cs: DataFrame, *, total: Sum = plain_sum) -> DataFrame:
    """C4: ``k = SUM(fs) / SUM(cs)`` per brand and period, 0 when undefined.

    One row per bucket: at most one more than the brand map has.
    """
    sums = cs.groupBy("brand").agg(
        total("spent_p1_cs").alias("panel_p1"),
        total("spent_p2_cs").alias("panel_p2"),
        total("spent_p1_fs").alias("market_p1"),
        total("spent_p2_fs").alias("market_p2"),
    )
    return sums.select(
        "brand",
        ratio_or_zero("market_p1", "panel_p1").alias("corr_factor_p1"),
        ratio_or_zero("market_p2", "panel_p2").alias("corr_factor_p2"),
    )


def _with_factors(cs: DataFrame, factors: DataFrame, share: float | None) -> DataFrame:
    """``cs`` with its brands' factors, of which there are too many to broadcast; ``cs`` itself is not shuffled.

    Only its keys are: (household, brand) goes to the factors, by brand, and comes back,
    by household, as one sorted array a household. ``cs`` is gathered to such an array
    too, where it lies, so C3's bucketing by household serves this join and what follows.
    Both arrays hold the household's brands in the same order.
    """
    values = [c for c in cs.columns if c not in ("hhkey", "brand")]
    k = ["corr_factor_p1", "corr_factor_p2"]

    def found(part: DataFrame, table: DataFrame) -> DataFrame:
        return part.join(table, "brand").select("hhkey", "brand", *k)

    known = cs.where("hhkey IS NOT NULL")
    looked_up = joined_apart(known.select("hhkey", "brand"), factors, "brand", found, share=share)
    looked_up = looked_up.groupBy("hhkey").agg(F.sort_array(F.collect_list(F.struct("brand", *k))).alias("ks"))
    held = known.groupBy("hhkey").agg(F.sort_array(F.collect_list(F.struct("brand", *values))).alias("held"))
    zipped = held.join(looked_up.hint("merge"), "hhkey").select("hhkey", F.explode(F.arrays_zip("held", "ks")).alias("z"))
    rows = zipped.select("hhkey", F.col("z.held.brand").alias("brand"), *[F.col(f"z.held.{c}").alias(c) for c in values], *[F.col(f"z.ks.{c}").alias(c) for c in k])
    # rows without a household share no key of that join
    loose = joined_apart(cs.where("hhkey IS NULL"), factors, "brand", lambda part, table: part.join(table, "brand"), share=share)
    return rows.unionByName(loose.select(*rows.columns))


def corrected_spend(
    cs: DataFrame,
    factors: DataFrame,
    *,
    max_buckets: int | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    share: float | None = None,
) -> DataFrame:
    """``spent = cs * k``, reusing the pre-run aggregate; zero-spend rows dropped.

    A (household, brand) row is kept when its continuous-sample spend is
    non-zero in some period. For C3 output (household copies folded) that is:
    some copy has a non-zero weight and the unweighted spend is non-zero.

    The factors, those of ``cs`` itself, are broadcast if ``max_buckets`` (a proven bound) or else
    their count is at most ``max_broadcast_rows``; beyond that they are joined
    without a shuffle of ``cs``.
    """
    if max_buckets is None or max_buckets > max_broadcast_rows:
        max_buckets = factors.limit(max_broadcast_rows + 1).count()
    if max_buckets <= max_broadcast_rows:
        j = cs.join(F.broadcast(factors), "brand")
    else:
        j = _with_factors(cs, factors, share)
    if "n_active" in cs.columns:
        keep = (F.col("n_active") > 0) & ((F.col("spent_p1_ics") != 0) | (F.col("spent_p2_ics") != 0))
    else:
        keep = (F.col("spent_p1_cs") != 0) | (F.col("spent_p2_cs") != 0)
    return j.where(keep).select(
        "hhkey",
        "brand",
        (F.col("spent_p1_cs") * F.col("corr_factor_p1")).alias("spent_p1"),
        (F.col("spent_p2_cs") * F.col("corr_factor_p2")).alias("spent_p2"),
    )


def corrected_spend_raw(
    classified: DataFrame,
    factors: DataFrame,
    households: DataFrame,
    *,
    two_level: bool = False,
    max_buckets: int | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    total: Sum = plain_sum,
) -> DataFrame:
    """Second pass over the classified rows with the factor inside the sum.

    Brands without a factor drop out (inner join); households with weight 0 or
    NULL drop out; the weight is applied after the sum. The factors are broadcast
    as in C6; beyond the bound the rows are shuffled by brand, but for those of
    brands with a large share of them (``lookup.lookup_join``).
    """
    base = F.col("value") * F.col("brandfactor") if "brandfactor" in classified.columns else F.col("value")
    rows = lookup_join(classified, factors, "brand", n_rows=max_buckets, max_rows=max_broadcast_rows)
    x = [base * F.col(f"corr_factor_p{n}") for n in (1, 2)]
    names = ["_s1", "_s2"]

    rows = rows.select("hhkey", "brand", "period", *[in_period("period", n, v).alias(name) for n, v, name in zip((1, 2), x, names)])
    sums = [total(name).alias(name) for name in names]
    if two_level:
        rows = rows.groupBy("hhkey", "brand", "period").agg(*sums)
    spend = rows.groupBy("hhkey", "brand").agg(*sums)
    hh = household_weights(households, total=total).where(F.col("n_active") > 0)
    return spend.join(hh, "hhkey").select(
        "hhkey",
        "brand",
        (F.col("_s1") * F.col("continuo")).alias("spent_p1"),
        (F.col("_s2") * F.col("continuo")).alias("spent_p2"),
    )
