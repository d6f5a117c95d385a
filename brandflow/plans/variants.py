"""The whole analysis (V1-V7): one function, the variants as option sets.

The seven variants compute the same matrix and differ in how: where the
purchases come from, whether the date filter is written, whether the pre-run
aggregate is reused for the main run, and whether the cseg totals are joined
back or taken from a window. Every variant shares the stage functions in
``brandflow.operators``.

| variant | input | date filter | spend | main run | allocation |
|---|---|---|---|---|---|
| v1 | raw purchases, string dates | no (period 3 kept) | two-level | re-aggregate raw rows (C5) | join (C7+C8) |
| v2 | purchase store (C13) | no | two-level | C5 | join |
| v3 | purchase store | yes | two-level | C5 | join |
| v4 | purchase store | yes | two-level, brandfactor folded | reuse pre-run (C6) | join |
| v5 | purchase store | yes | two-level, folded | C6 | window (C9) |
| v6 | purchase store | yes | one pass, folded | C6 | window |
| v7 | pre-weighted store (C14) | yes | one pass | C6 | window |

Results agree cell for cell except at documented edges: v1/v2 keep all-zero
cells of brands bought only outside both periods, and v1-v3 keep all-zero or
NULL cells of brands whose spend is zero or NULL (they filter on household
weight, v4-v7 on spend).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions import Periods, exact_sum, plain_sum
from ..operators import (
    classify,
    continuous_sample,
    corrected_spend,
    corrected_spend_raw,
    correction_factors,
    cseg_allocation_join,
    cseg_allocation_window,
    gain_loss_matrix,
    spend_by_household_brand,
)
from ..operators.lookup import MAX_BROADCAST_ROWS
from ..operators.matrix import BLOCK
from ..sources.brand_map import map_profile
from ..sources.stores import materialize_by_household, scratch_root


@dataclass(frozen=True)
class Variant:
    date_filter: bool = True
    fold_brandfactor: bool = True
    two_level: bool = False
    reuse_pre_run: bool = True
    allocation: str = "window"  # or "join"
    source: str = "purchase_store"  # "raw", "purchase_store" or "weighted_store"


VARIANTS = {
    "v1": Variant(False, False, True, False, "join", "raw"),
    "v2": Variant(False, False, True, False, "join", "purchase_store"),
    "v3": Variant(True, False, True, False, "join", "purchase_store"),
    "v4": Variant(True, True, True, True, "join", "purchase_store"),
    "v5": Variant(True, True, True, True, "window", "purchase_store"),
    "v6": Variant(True, True, False, True, "window", "purchase_store"),
    "v7": Variant(True, True, False, True, "window", "weighted_store"),
}


def max_buckets(brand_map: DataFrame) -> int:
    """Most buckets that purchases can fall into: one for each row of the map at most, and REST."""
    return map_profile(brand_map).n_rows + 1


def allocated_spend(
    purchases: DataFrame,
    households: DataFrame | None,
    brand_map: DataFrame,
    periods: Periods,
    variant: Variant,
    *,
    materialize: str | None = None,
    exact: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Everything up to C8/C9: ``hhkey, brand, spent_p1, spent_p2, cseg_p1, cseg_p2, cseg``.

    ``materialize`` (default for v4-v7, which reuse the pre-run) writes the
    per-(household, brand) table C3 into the cluster's checkpoint folder before
    it feeds both the correction factors and the main run. Without it both
    branches would rescan and re-aggregate the purchases: they need different
    columns of C3, so Spark cannot share one shuffle between them. C3 is small
    next to the purchases (at most one row per household and bucket), and the
    cut also bounds the lineage replayed after an executor loss.

    - ``"table"`` (default): a table bucketed by ``hhkey``; the household join
      is then a shuffle join on ``hhkey``, the write adds no shuffle, and the
      windows of C9 and C12 read the table without one.
    - ``"checkpoint"``: ``Dataset.checkpoint()``; under AQE the result does not
      keep its partitioning, so C3 is shuffled once more for the windows.
    - ``"none"``: no cut (both branches recompute C3).

    v1-v3 re-aggregate the raw rows in the main run by design; they default to "none".

    ``exact`` sums without dependence on the order of rows. ``max_broadcast_rows`` bounds
    what is broadcast: the brand map, and the factors, which have at most one row more.
    """
    total = exact_sum if exact else plain_sum
    if materialize is None:
        materialize = "table" if variant.reuse_pre_run else "none"
    if materialize not in ("table", "checkpoint", "none"):
        raise ValueError("materialize must be 'table', 'checkpoint' or 'none'")
    classified = classify(
        purchases,
        brand_map,
        periods,
        date_filter=variant.date_filter,
        fold_brandfactor=variant.fold_brandfactor,
        max_broadcast_rows=max_broadcast_rows,
    )
    spend = spend_by_household_brand(classified, two_level=variant.two_level, total=total)
    weighted = "spent_p1_cs" in spend.columns  # pre-weighted input: the household weight is in already
    if weighted:
        cs = spend
    else:
        if households is None:
            raise ValueError("households are required unless the purchases are pre-weighted")
        cs = continuous_sample(spend, households, by_household=materialize == "table", total=total)
    if materialize == "table":
        # after the household join C3 is already hash-partitioned by hhkey
        cs = materialize_by_household(cs, "c3", partitioned=not weighted)
    elif materialize == "checkpoint":
        scratch_root(cs.sparkSession)  # the session's checkpoint folder (own one only if unset)
        cs = cs.checkpoint(eager=True)
    factors = correction_factors(cs, total=total)
    bound = {"max_buckets": max_buckets(brand_map), "max_broadcast_rows": max_broadcast_rows}
    if variant.reuse_pre_run:
        spent = corrected_spend(cs, factors, **bound)
    else:
        if households is None:
            raise ValueError("re-aggregating raw rows needs the household table")
        spent = corrected_spend_raw(classified, factors, households, two_level=variant.two_level, total=total, **bound)
    if variant.allocation == "join":
        return cseg_allocation_join(spent, total=total)
    return cseg_allocation_window(spent, total=total)


def gain_loss(
    purchases: DataFrame,
    households: DataFrame | None,
    brand_map: DataFrame,
    periods: Periods = Periods(),
    *,
    variant: str | Variant = "v6",
    digits: int = 2,
    materialize: str | None = None,
    exact: bool = False,
    block: int = BLOCK,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Brand-by-brand gains and losses: ``B1, B2, total_gains_b1_to_b2, total_losses_b1_to_b2``.

    Unless ``materialize="none"``, the call itself runs jobs: a look at the size
    of the brand map, and the write of C3. ``sources.drop_scratch_tables`` removes
    the C3 tables of this application once its results are no longer needed.

    ``purchases`` must match the variant's source: raw rows (string or DATE
    ``datep``) for v1-v6, pre-weighted rows for v7 (then ``households`` may be None).

    ``exact=True`` gives the same bits for any order and partitioning of the rows, at the
    price of four integer sums for each sum. ``block`` and ``max_broadcast_rows`` are the
    sizes beyond which a household's pairs are dealt out and tables are not broadcast.
    """
    v = VARIANTS[variant] if isinstance(variant, str) else variant
    allocated = allocated_spend(
        purchases, households, brand_map, periods, v, materialize=materialize, exact=exact, max_broadcast_rows=max_broadcast_rows
    )
    total = exact_sum if exact else plain_sum
    return gain_loss_matrix(allocated, digits=digits, max_buckets=max_buckets(brand_map), block=block, total=total)
