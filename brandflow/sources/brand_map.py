"""The brand map: which purchase brands roll up into which analysis bucket.

The map is a small dimension table. It is broadcast only after a row count
proves it small (otherwise it is joined like any other table).
"""

from __future__ import annotations

import weakref
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import REST_BUCKET
from .schemas import BRAND_MAP

# Same columns as BRAND_MAP, nullable, for the local copy of a map as it was read.
_LOCAL_SCHEMA = T.StructType([T.StructField(f.name, f.dataType) for f in BRAND_MAP.fields])

# Largest brand map that is broadcast to every task.
MAX_BROADCAST_MAP_ROWS = 1_000_000
# The retailer brand map of the reference study, in its order
# (brand, aggregation). The last two brands fold into FACHHANDEL.
REFERENCE_BRAND_MAP = [
    ("KAUFLAND", "KAUFLAND"),
    ("MARKTKAUF", "MARKTKAUF"),
    ("REAL", "REAL"),
    ("REWE", "REWE"),
    ("EDEKA EH", "EDEKA EH"),
    ("GLOBUS ST. WENDEL", "GLOBUS ST. WENDEL"),
    ("TENGELMANN/KAISERS", "TENGELMANN/KAISERS"),
    ("REST LEH-VOLLSORTIMENTER FOOD", "REST LEH-VOLLSORTIMENTER FOOD"),
    ("ALDI", "ALDI"),
    ("LIDL", "LIDL"),
    ("NETTO MARKEN-DISCOUNT", "NETTO MARKEN-DISCOUNT"),
    ("NORMA", "NORMA"),
    ("PENNY", "PENNY"),
    ("PLUS", "PLUS"),
    ("REST DISCOUNTER", "REST DISCOUNTER"),
    ("DM", "DM"),
    ("MUELLER", "MUELLER"),
    ("ROSSMANN", "ROSSMANN"),
    ("SCHLECKER", "SCHLECKER"),
    ("REST DROGERIEMAERKTE", "REST DROGERIEMAERKTE"),
    ("FACHHANDEL", "FACHHANDEL"),
    ("FACHHANDEL NICHT STAT. SONST.", "FACHHANDEL"),
    ("FACHHANDEL STATIONAER", "FACHHANDEL"),
]


def brand_map_from_rows(spark: SparkSession, rows) -> DataFrame:
    """Create a brand map from (brand, aggregation) pairs; NULLs are rejected."""
    return spark.createDataFrame(list(rows), BRAND_MAP)


def reference_brand_map(spark: SparkSession) -> DataFrame:
    return brand_map_from_rows(spark, REFERENCE_BRAND_MAP)


def _not_null(name: str) -> F.Column:
    message = F.lit(f"NULL value in NOT NULL column {name} of a brand map")
    return F.when(F.col(name).isNull(), F.raise_error(message).cast("string")).otherwise(F.col(name)).alias(name)


def write_brand_map(brand_map: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store a brand map (``CREATE TABLE`` + ``INSERT``): 'errorifexists' or 'append'.

    Both columns are NOT NULL: a row with a NULL in either makes the write fail.
    """
    brand_map.select(_not_null("brand"), _not_null("aggregation")).write.mode(mode).parquet(path)


def read_brand_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRAND_MAP).parquet(path)


# A map with at most this many rows is read once and planned as a local relation.
LOCAL_MAP_ROWS = 10_000


class MapProfile(NamedTuple):
    n_rows: int
    local: DataFrame | None  # the map as a local relation, when it is small


_PROFILES: "weakref.WeakKeyDictionary[DataFrame, MapProfile]" = weakref.WeakKeyDictionary()


def map_profile(brand_map: DataFrame) -> MapProfile:
    """Row count and (when small) a local copy of a brand map, in one small job.

    At most ``LOCAL_MAP_ROWS + 1`` rows are read to the driver. A small map is
    kept as a local relation, so later plans neither rescan nor recompute it
    (a broadcast would ship it through the driver anyway). Of a larger one only
    the count comes back. The result is remembered per DataFrame.
    """
    if brand_map not in _PROFILES:
        m = brand_map.select("brand", "aggregation")
        rows = m.limit(LOCAL_MAP_ROWS + 1).collect()
        if len(rows) <= LOCAL_MAP_ROWS:
            _PROFILES[brand_map] = MapProfile(len(rows), brand_map.sparkSession.createDataFrame(rows, _LOCAL_SCHEMA))
        else:
            _PROFILES[brand_map] = MapProfile(m.count(), None)
    return _PROFILES[brand_map]


def checked_map(brand_map: DataFrame, max_rows: int = MAX_BROADCAST_MAP_ROWS) -> DataFrame:
    """The brand map, broadcast-hinted when its row count is proven small.

    Beyond ``max_rows`` no hint is given and the planner joins it like any
    other table (sort-merge, or a broadcast AQE picks from runtime sizes). That
    join shuffles the purchases by brand; a brand with a large share of them is
    split by AQE's skew join, which must then be on.
    """
    prof = map_profile(brand_map)
    if prof.local is not None and prof.n_rows <= max_rows:
        return F.broadcast(prof.local)
    m = brand_map.select("brand", "aggregation")
    return F.broadcast(m) if prof.n_rows <= max_rows else m


def bucket_names(brand_map: DataFrame) -> list[str]:
    """Sorted bucket names of a map, plus the catch-all bucket for unmapped brands."""
    names = {r[0] for r in brand_map.select("aggregation").distinct().collect() if r[0] is not None}
    return sorted(names | {REST_BUCKET})


def map_checks(brand_map: DataFrame) -> DataFrame:
    """Brands mapped more than once (each such purchase counts once per bucket)."""
    return (
        brand_map.groupBy("brand")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("aggregation").alias("n_buckets"))
        .where(F.col("n_rows") > 1)
    )
