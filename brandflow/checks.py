"""Data checks for users: conditions under which the analysis still runs but
its result deserves a second look. Each check is one small aggregation and
returns a count, never rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import Periods
from .sources.brand_map import map_checks


def panel_checks(
    purchases: DataFrame, households: DataFrame | None, brand_map: DataFrame, periods: Periods
) -> dict[str, int | bool]:
    """Counts of: brands mapped to more than one bucket (their purchases count
    once per bucket), households listed more than once (their spend counts once
    per copy), purchases with negative spend (refunds: cseg can turn negative),
    and whether the periods overlap (an overlapping day counts in period 1)."""
    if "spent_cs" in purchases.columns:
        negative = F.col("spent_cs") < 0
    else:
        negative = F.col("value") * F.col("brandfactor") < 0
    out: dict[str, int | bool] = {
        "brands_mapped_twice": map_checks(brand_map).count(),
        "negative_spend_rows": purchases.where(negative).count(),
        "periods_overlap": periods.overlap(),
    }
    if households is not None:
        out["households_listed_twice"] = (
            households.groupBy("hhkey").count().where(F.col("count") > 1).count()
        )
    return out
