"""Classified purchases (brand bucket + period per purchase row)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import REST_BUCKET, Periods, in_month_periods, in_periods, parse_yyyymmdd, period_of
from ..sources.brand_map import MAX_BROADCAST_MAP_ROWS, checked_map, map_profile
from ..sources.stores import MONTH
from .lookup import joined_apart


def classify(
    purchases: DataFrame,
    brand_map: DataFrame,
    periods: Periods,
    *,
    date_filter: bool = True,
    three_way: bool | None = None,
    fold_brandfactor: bool = True,
    parse_dates: bool | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_MAP_ROWS,
) -> DataFrame:
    """Map each purchase to its brand bucket and its period.

    - ``date_filter``: keep only rows in period 1 or 2. On a date-partitioned
      store this becomes a partition filter on the scan.
    - ``three_way``: period 1, 2, else 3 (default when there is no date filter);
      otherwise 1, else 2.
    - ``fold_brandfactor``: return ``value * brandfactor`` as ``value``.
    - ``parse_dates``: ``datep`` is a 'yyyyMMdd' string (default: detected from the type).

    Purchases may be raw (``value, brandfactor, rwkorr, rwstd, fullmasW``) or
    pre-weighted (``spent_cs, spent_fs``); the measures are carried through.
    The brand map is broadcast after a size check (``max_broadcast_rows``); with a
    larger one the purchases are shuffled by brand, but for those of brands with a
    large share of the rows and those without a brand (``lookup.joined_apart``). A
    brand absent from the map, or NULL, lands in the REST bucket; a brand mapped
    twice counts in both buckets.
    """
    if parse_dates is None:
        parse_dates = dict(purchases.dtypes).get("datep") == "string"
    if three_way is None:
        three_way = not date_filter
    weighted = "spent_cs" in purchases.columns

    p = purchases
    datep = parse_yyyymmdd(F.col("p.datep")) if parse_dates else F.col("p.datep")
    if date_filter:
        cond = in_periods(datep, periods)
        if MONTH in purchases.columns:
            # a month-partitioned store: add the month predicate the date filter
            # implies, so whole month directories are pruned
            cond = in_month_periods(F.col(f"p.{MONTH}"), periods) & cond
        p = p.alias("p").where(cond)
    bucket = (
        F.when(F.col("ba.brand").isNotNull(), F.col("ba.aggregation"))
        .otherwise(F.lit(REST_BUCKET))
        .alias("brand")
    )
    if weighted:
        measures = [F.col("p.spent_cs").alias("spent_cs"), F.col("p.spent_fs").alias("spent_fs")]
    elif fold_brandfactor:
        measures = [(F.col("p.value") * F.col("p.brandfactor")).alias("value")] + [
            F.col(f"p.{c}").alias(c) for c in ("rwkorr", "rwstd", "fullmasW")
        ]
    else:
        measures = [F.col(f"p.{c}").alias(c) for c in ("value", "brandfactor", "rwkorr", "rwstd", "fullmasW")]
    out = [F.col("p.hhkey").alias("hhkey"), bucket, *measures, datep.alias("datep"), period_of(datep, periods, filtered=not three_way).alias("period")]

    def mapped(rows: DataFrame, brands: DataFrame) -> DataFrame:
        return rows.alias("p").join(brands.alias("ba"), F.col("p.brand") == F.col("ba.brand"), "left").select(*out)

    if map_profile(brand_map).n_rows <= max_broadcast_rows:
        return mapped(p, checked_map(brand_map))
    return joined_apart(p, brand_map.select("brand", "aggregation"), "brand", mapped)
