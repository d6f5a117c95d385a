"""Stores: round trip, partition pruning, layout."""

import glob

import pyarrow.parquet as pq
import pytest
from panel import purchases_df
from pyspark.sql import functions as F

from brandflow.operators import classify
from brandflow.sources import read_purchase_store, read_weighted_store, tpch
from brandflow.operators import continuous_sample, spend_by_household_brand
from brandflow.sources.stores import scratch_path, weighted_purchases, write_purchase_store, write_weighted_store

SF = "/root/testdata/sf0.001"


def _scan_line(df):
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return [line for line in plan.splitlines() if "FileScan parquet" in line][0]


@pytest.mark.parametrize("granularity,part", [("month", "month"), ("day", "datep")])
def test_purchase_store_round_trip_and_pruning(spark, granularity, part):
    p = tpch.purchases(spark, SF, string_dates=True)
    path = write_purchase_store(p, scratch_path(spark, f"test-store-{granularity}"), granularity=granularity)
    back = read_purchase_store(spark, path)
    assert dict(back.dtypes)["datep"] == "date"
    assert back.count() == p.count()
    want = p.withColumn("datep", F.to_date("datep", "yyyyMMdd"))
    cols = ["hhkey", "occaskey", "brand", "datep", "value", "brandfactor", "rwkorr", "rwstd", "fullmasW"]
    assert want.select(cols).exceptAll(back.select(cols)).count() == 0
    # the date filter of the analysis prunes partition directories
    _, _, bm, per = tpch.panel(spark, SF)
    scan = _scan_line(classify(back, bm, per, date_filter=True))
    pruned = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert part in pruned
    if granularity == "month":
        # the day filter also reaches the Parquet reader
        assert "datep" in scan.split("PushedFilters: [")[1].split("]")[0]
        months = back.select("month").distinct().count()
        assert months == back.select(F.trunc("datep", "month")).distinct().count()


@pytest.mark.parametrize("granularity", ["month", "day"])
@pytest.mark.parametrize("table", [None, "brandflow_order_test"])
@pytest.mark.parametrize("kind", ["purchase", "weighted"])
def test_every_file_is_clustered(spark, granularity, table, kind):
    """Rows of every written file, in file order: by household, brand and day."""
    p, hh, _, _ = tpch.panel(spark, SF)
    path = scratch_path(spark, "clustered")
    if kind == "purchase":
        write_purchase_store(p, path, granularity=granularity, table=table)
    else:
        write_weighted_store(p, hh, path, granularity=granularity, table=table)
    if table:
        spark.sql(f"DROP TABLE {table}")
    files = glob.glob(f"{path}/*/*.parquet")
    assert len(files) >= 80
    for f in files:
        columns = ["hhkey", "brand"] + (["datep"] if granularity == "month" else [])
        rows = [tuple(r.values()) for r in pq.read_table(f, columns=columns, partitioning=None).to_pylist()]
        assert rows == sorted(rows)


def test_all_columns_are_kept(spark):
    p = purchases_df(spark, ["1:A:19960105:10", "2:B:19970105:-4"])
    path = write_purchase_store(p, scratch_path(spark, "all-columns"))
    back = read_purchase_store(spark, path)
    assert sorted(back.select("occaskey", "recid", "continuo").collect()) == [(0, 0, 0.5), (1, 7, 0.5)]
    assert set(p.columns) <= set(back.columns) and len(p.columns) == 11


def test_weighted_store_keeps_totals(spark):
    p, hh, _, _ = tpch.panel(spark, SF, string_dates=True)
    path = write_weighted_store(p, hh, scratch_path(spark, "test-wstore"))
    back = read_weighted_store(spark, path)
    joined = p.drop("continuo").join(hh, "hhkey")
    want = joined.agg(F.sum(F.col("value") * F.col("brandfactor") * F.col("continuo"))).first()[0]
    got = back.agg(F.sum("spent_cs")).first()[0]
    assert abs(got - want) <= 1e-6 * abs(want)
    assert back.count() == joined.count()


def _below(plan: str, exchange: str) -> list[str]:
    """What is read below each shuffle of a plan that begins like ``exchange``."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines, out = plan.splitlines(), []
    for k, line in enumerate(lines):
        if exchange in line:
            end = next((n for n in range(k + 1, len(lines)) if depth(lines[n]) <= depth(line)), len(lines))
            out.append("\n".join(lines[k + 1 : end]))
    return out


def _panel_tables(spark, folder) -> str:
    """Repeated, null and unmatched keys in every table."""
    day = "TIMESTAMP_NTZ'1996-05-0{} 13:00:00'"
    tables = {
        "customer": "SELECT * FROM VALUES (1L), (2L), (2L), (10L), (NULL), (7L) AS t(c_custkey)",
        "part": "SELECT * FROM VALUES (1L, 'Brand#1'), (2L, 'Brand#14'), (3L, 'Brand#22'), (4L, NULL), (NULL, 'Brand#2') AS t(p_partkey, p_brand)",
        "orders": "SELECT * FROM VALUES (1L, 1L), (2L, 2L), (3L, 2L), (4L, 10L), (5L, NULL), (6L, 99L), (NULL, 1L), (7L, 7L), (7L, 1L) AS t(o_orderkey, o_custkey)",
        "lineitem": "SELECT id % 9 AS l_orderkey, CASE WHEN id % 6 > 0 THEN id % 6 END AS l_partkey, CAST(id % 4 AS INT) AS l_linenumber, CAST(id % 50 AS DOUBLE) AS l_quantity,"
        f" id * 3.17D AS l_extendedprice, CASE WHEN id <> 11 THEN id % 11 / 100D END AS l_discount, id % 9 / 100D AS l_tax, IF(id % 2 = 0, {day.format(3)}, {day.format(4)}) AS l_shipdate FROM range(200)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_weights_come_in_with_the_orders(spark, tmp_path):
    """The same rows as weighting whole purchases, without a shuffle of them by household."""
    sf = _panel_tables(spark, tmp_path)
    p, hh, _, _ = tpch.panel(spark, sf)
    usual = sorted(map(str, weighted_purchases(p, hh).collect()))
    rows = tpch.weighted(spark, sf, spread_scan=True)
    assert sorted(map(str, rows.collect())) == usual and len(usual) > 50
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tpch.weighted(spark, sf, spread_scan=True)._jdf.queryExecution().executedPlan().toString()
        shuffled = _below(plan, "Exchange hashpartitioning(hhkey")
        assert shuffled and not any("l_partkey" in below for below in shuffled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_two_level_spend_is_shuffled_by_household_once(spark):
    """After the sums by period, the other sums and the household join keep the partitioning by household."""
    classified = spark.sql("SELECT id % 5 AS hhkey, CONCAT('B', id % 3) AS brand, 1 + id % 2 AS period, id * 1D AS value, 1D AS rwkorr, 1D AS rwstd, 1D AS fullmasW FROM range(60)")
    hh = spark.sql("SELECT id AS hhkey, 0.5D AS continuo FROM range(5)")
    cs = continuous_sample(spend_by_household_brand(classified, two_level=True), hh, by_household=True)
    plan = cs._jdf.queryExecution().executedPlan().toString()
    by_spend = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "brand" in line]
    assert len(by_spend) == 1 and plan.count("Exchange hashpartitioning") == 3
    want = sorted(map(str, continuous_sample(spend_by_household_brand(classified), hh).collect()))
    assert sorted(map(str, cs.collect())) == want and len(want) == 15
