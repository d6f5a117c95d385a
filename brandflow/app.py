"""Run the analysis as a Spark application (the counterpart of calling the procedure).

    spark-submit brandflow/app.py --purchases s3://…/purchases --households s3://…/households \
        --p1 2019-01-01 2019-12-31 --p2 2020-01-01 2020-12-31 --out s3://…/gain_loss

Without ``--brand-map`` the reference retailer map is used. ``--store`` reads a
store written by ``write_purchase_store`` / ``write_weighted_store`` (table
name or path) instead of raw files; ``--build-store`` writes one first.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from brandflow.functions import Periods  # noqa: E402
from brandflow.plans import VARIANTS, gain_loss  # noqa: E402
from brandflow.sources import (  # noqa: E402
    read_brand_map,
    read_households,
    read_purchase_store,
    read_purchases,
    read_weighted_store,
    reference_brand_map,
    write_purchase_store,
    write_weighted_store,
)


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(description="Brand gain/loss analysis")
    ap.add_argument("--purchases", help="raw purchase files")
    ap.add_argument("--households", help="household weight files")
    ap.add_argument("--format", default="parquet", choices=["parquet", "orc", "csv", "json"])
    ap.add_argument("--brand-map", help="stored brand map (Parquet); default: the reference map")
    ap.add_argument("--store", help="purchase store (v2-v6) or pre-weighted store (v7): table name or path")
    ap.add_argument("--build-store", help="write the variant's store here first (path)")
    ap.add_argument("--p1", nargs=2, type=_date, metavar=("START", "END"))
    ap.add_argument("--p2", nargs=2, type=_date, metavar=("START", "END"))
    ap.add_argument("--variant", default="v6", choices=sorted(VARIANTS))
    ap.add_argument("--out", help="write the matrix here (Parquet); default: print it")
    args = ap.parse_args(argv)
    if (args.p1 is None) != (args.p2 is None):
        ap.error("--p1 and --p2 go together")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    periods = Periods()
    if args.p1 and args.p2:
        periods = Periods(args.p1[0], args.p1[1], args.p2[0], args.p2[1])
    brand_map = read_brand_map(spark, args.brand_map) if args.brand_map else reference_brand_map(spark)
    v = VARIANTS[args.variant]
    households = read_households(spark, args.households, args.format) if args.households else None
    store = args.store
    if args.build_store:
        raw = read_purchases(spark, args.purchases, args.format)
        if v.source == "weighted_store":
            store = write_weighted_store(raw, households, args.build_store)
        else:
            store = write_purchase_store(raw, args.build_store)
    if v.source == "weighted_store":
        purchases, households = read_weighted_store(spark, store), None
    elif v.source == "purchase_store" and store:
        purchases = read_purchase_store(spark, store)
    else:
        purchases = read_purchases(spark, args.purchases, args.format)
    return gain_loss(purchases, households, brand_map, periods, variant=args.variant)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("brandflow-gain-loss").getOrCreate()
    result = run(spark, args)
    if args.out:
        result.write.mode("errorifexists").parquet(args.out)
    else:
        print(*result.columns, sep="\t")
        for row in result.toLocalIterator():  # every cell
            print(*row, sep="\t")


if __name__ == "__main__":
    main()
