"""Inputs and stores: schemas, brand map, TPC-H-derived panel, partitioned stores."""

from . import tpch
from .raw import read_households, read_purchases
from .brand_map import (
    REFERENCE_BRAND_MAP,
    brand_map_from_rows,
    bucket_names,
    checked_map,
    map_checks,
    map_profile,
    read_brand_map,
    reference_brand_map,
    write_brand_map,
)
from .months import compact_months, drop_old_months, merge_rows, month_locations, update_weights
from .stores import (
    drop_scratch_tables,
    household_history,
    read_purchase_store,
    read_weighted_store,
    scratch_path,
    scratch_root,
    weighted_purchases,
    write_purchase_store,
    write_weighted_store,
)

__all__ = [
    "REFERENCE_BRAND_MAP",
    "brand_map_from_rows",
    "bucket_names",
    "checked_map",
    "compact_months",
    "drop_old_months",
    "drop_scratch_tables",
    "household_history",
    "map_checks",
    "map_profile",
    "merge_rows",
    "month_locations",
    "read_brand_map",
    "read_households",
    "read_purchases",
    "read_purchase_store",
    "read_weighted_store",
    "reference_brand_map",
    "scratch_path",
    "scratch_root",
    "tpch",
    "update_weights",
    "weighted_purchases",
    "write_brand_map",
    "write_purchase_store",
    "write_weighted_store",
]
