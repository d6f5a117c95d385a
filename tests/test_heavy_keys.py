"""Households of very many buckets, maps too large to broadcast, brands with a third of the rows; AQE's skew join is off."""

import random

import pytest
from pyspark.sql import functions as F

from brandflow.functions import Periods
from brandflow.operators import classify, continuous_sample, corrected_spend, corrected_spend_raw, correction_factors, spend_by_household_brand
from brandflow.operators.lookup import heavy_keys, joined_apart, lookup_join
from brandflow.operators.matrix import _across, _blocks, flow_sums
from brandflow.plans import gain_loss
from brandflow.sources import brand_map_from_rows, tpch
from brandflow.sources.stores import materialize_by_household

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_skew_join(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- heavy households


def allocated(spark, households):
    """{household: number of buckets}: random allocations, some NULL."""
    rng = random.Random(5)
    rows = []
    for h, k in households.items():
        for b in rng.sample(range(max(households.values())), k):
            q1 = None if rng.random() < 0.02 else round(rng.random() * 50, 3)
            rows.append((h, f"b{b:05d}", q1, round(rng.random() * 50, 3), 40.0))
    return spark.createDataFrame(rows, "hhkey long, brand string, cseg_p1 double, cseg_p2 double, cseg double").repartition(5)


def brute(df):
    cells = {}
    held = {}
    for r in df.collect():
        held.setdefault(r["hhkey"], []).append(r)
    for rows in held.values():
        for x in rows:
            for y in rows:
                cell = cells.setdefault((x["brand"], y["brand"]), [None, None, 0])
                for n, term in enumerate((None if y["cseg_p1"] is None else y["cseg_p1"] * (x["cseg_p2"] / x["cseg"]), None if x["cseg_p1"] is None else x["cseg_p1"] * (y["cseg_p2"] / y["cseg"]))):
                    if term is not None:
                        cell[n] = (cell[n] or 0.0) + term
                cell[2] += 1
    return cells


def same(got, want):
    got = {(r["B1"], r["B2"]): (r["gains"], r["losses"], r["n_households"]) for r in got}
    assert got.keys() == want.keys()
    for cell, (gains, losses, n) in want.items():
        assert got[cell] == (pytest.approx(gains, rel=1e-12) if gains is not None else None, pytest.approx(losses, rel=1e-12) if losses is not None else None, n), cell


@pytest.mark.parametrize("block", [1, 3, 7, 64])
def test_blocks_equal_brute_force(spark, block):
    df = allocated(spark, {1: 60, 2: 1, 3: 7, 4: 8, 5: 14, 6: 22, None: 9})
    same(flow_sums(df, max_buckets=61, block=block).collect(), brute(df))


def test_heavy_household_runs_in_bounded_units(spark):
    df = allocated(spark, {1: 600, **{h: 5 for h in range(2, 40)}})
    block = 50
    blocks = _blocks(df, F.struct(F.col("brand").alias("b"), "cseg_p1"), block)
    assert {r["size"] for r in blocks.where("hhkey = 1").select(F.size("held").alias("size")).collect()} == {block}
    pairs = _across(blocks)
    assert pairs.count() == sum(1 for i in range(12) for j in range(i + 1, 12)) * block * block
    shares = [r["n"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(shares) == 8 and max(shares) < 0.4 * sum(shares)  # every shuffle partition has a part of the one household
    same(flow_sums(df, max_buckets=601, block=block).collect(), brute(df))


def test_small_maps_keep_the_plan_without_blocks(spark):
    df = allocated(spark, {1: 5})
    assert "Window" not in plan(flow_sums(df, max_buckets=20)) and "Window" in plan(flow_sums(df, max_buckets=20, block=10))


def test_blocks_read_a_bucketed_table_without_a_household_shuffle(spark):
    table = materialize_by_household(allocated(spark, {h: 5 for h in range(50)}), "blocks")
    out = flow_sums(table, max_buckets=100, block=3)
    out.collect()
    assert "hashpartitioning(hhkey" not in plan(out).split("== Initial Plan ==")[0]


# ---------------------------------------------------------------- lookups with hot keys


def hot_rows(spark, n=30_000):
    """A third of the rows of one brand, a tenth without a brand, the others spread over many."""
    k = F.col("id")
    brand = F.when(k % 3 == 0, "hot").when(k % 10 == 1, None).otherwise(F.concat(F.lit("b"), (k % 997).cast("string")))
    return spark.range(n).select(F.col("id"), brand.alias("brand")).repartition(6)


def test_sketch_names_the_hot_key_only(spark):
    assert heavy_keys(hot_rows(spark), "brand") == ["hot"]
    assert heavy_keys(hot_rows(spark).where("false"), "brand") == []


def test_hot_key_never_enters_the_shuffle(spark):
    rows = hot_rows(spark)
    table = spark.range(500).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("brand"), F.col("id").alias("v"))
    table = table.unionByName(spark.createDataFrame([("hot", -1), ("hot", -2), ("unused", 3)], "brand string, v long"))
    seen = []

    def join(part, small):
        seen.append(part)
        return part.join(small, "brand", "left")

    out = joined_apart(rows, table, "brand", join)
    assert sorted(map(str, out.collect())) == sorted(map(str, rows.join(table, "brand", "left").collect()))
    shuffled = seen[1].groupBy("brand").count().collect()
    assert max(r["count"] for r in shuffled) < 60 and None not in {r["brand"] for r in shuffled}
    # dealt by brand, no partition holds much more than its share
    sizes = [r["count"] for r in seen[1].repartition(8, "brand").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1.5 * sum(sizes) / 8


def test_a_hot_key_with_many_table_rows_stays_in_the_shuffle(spark):
    rows = hot_rows(spark, 300)
    table = spark.range(150).select(F.lit("hot").alias("brand"), "id").withColumnRenamed("id", "v")
    out = joined_apart(rows, table, "brand", lambda part, t: part.join(t, "brand"))
    assert out.count() == 100 * 150


def test_lookup_is_broadcast_only_when_proven_small(spark):
    rows, table = hot_rows(spark, 3000), spark.range(100).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("brand"))
    assert "BroadcastHashJoin" in plan(lookup_join(rows, table, "brand", n_rows=100))
    assert "BroadcastHashJoin" in plan(lookup_join(rows, table, "brand", n_rows=10**9))  # the count proves it
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup_join(rows, table, "brand", max_rows=50)
        assert "SortMergeJoin" in plan(large)
        assert sorted(map(tuple, large.collect())) == sorted(map(tuple, rows.join(table, "brand").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_classify_with_a_large_map(spark):
    p, _, _, per = tpch.panel(spark, SF, string_dates=False)
    p = p.withColumn("brand", F.when(F.col("occaskey") % 3 == 0, F.lit("Brand#1")).when(F.col("occaskey") % 7 == 0, F.lit(None)).otherwise(F.col("brand")))
    bm = brand_map_from_rows(spark, [("Brand#1", "A"), ("Brand#2", "B"), ("Brand#2", "C"), *[(f"x{k}", "X") for k in range(300)]])
    small, large = classify(p, bm, per), classify(p, bm, per, max_broadcast_rows=100)
    assert small.columns == large.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert "leftanti" in plan(large).lower() and "leftanti" not in plan(small).lower()


# ---------------------------------------------------------------- correction factors


@pytest.fixture(scope="module")
def c3(spark):
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=False)
    classified = classify(p, bm, per, fold_brandfactor=False)
    cs = continuous_sample(spend_by_household_brand(classified), hh, by_household=True)
    return materialize_by_household(cs, "c3test", partitioned=True), classified, hh


def rounded(df):
    return sorted((r["hhkey"], r["brand"], round(r["spent_p1"], 6), round(r["spent_p2"], 6)) for r in df.collect())


def test_many_factors_are_joined_without_a_shuffle_of_c3(spark, c3):
    cs, _, _ = c3
    factors = correction_factors(cs)
    small, large = corrected_spend(cs, factors, max_buckets=20), corrected_spend(cs, factors, max_broadcast_rows=3, share=0.01)
    assert rounded(small) == rounded(large) and len(rounded(small)) > 100
    assert "Broadcast" in plan(small) and "SortMergeJoin" not in plan(small)
    text = plan(large)
    # the join by household: one side is the bucketed scan of C3 as it lies, the other comes from the factors
    join = text[text.index("SortMergeJoin [hhkey") :]
    side = join[: join.index("corr_factor_p1")]
    assert "Exchange hashpartitioning(hhkey" not in side and "Bucketed: true" in text


def test_factor_lookup_keeps_rows_without_a_household_and_brands_without_a_factor_out(spark):
    rows = [(1, "a", 1.0, 2.0), (1, "b", 3.0, 0.0), (None, "a", 5.0, 5.0), (None, "b", 0.0, 0.0), (2, "a", 7.0, 1.0), (3, "b", 1.0, 1.0)]
    cs = spark.createDataFrame(rows, "hhkey long, brand string, spent_p1_cs double, spent_p2_cs double")
    factors = spark.createDataFrame([("a", 2.0, 3.0), ("b", 0.5, 1.0)], "brand string, corr_factor_p1 double, corr_factor_p2 double")
    small, large = corrected_spend(cs, factors), corrected_spend(cs, factors, max_broadcast_rows=1)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert large.count() == 5


def test_factors_of_raw_rows(spark, c3):
    cs, classified, hh = c3
    factors = correction_factors(cs)
    small = corrected_spend_raw(classified, factors, hh, max_buckets=20)
    large = corrected_spend_raw(classified, factors, hh, max_broadcast_rows=3)
    assert rounded(small) == rounded(large) and len(rounded(small)) > 100


def test_whole_analysis_beyond_every_bound(spark):
    p, hh, bm, _ = tpch.panel(spark, SF, string_dates=False)
    per = Periods.years(1996, 1997)
    usual = gain_loss(p, hh, bm, per).collect()
    beyond = gain_loss(p, hh, bm, per, block=3, max_broadcast_rows=2, exact=True).collect()
    assert [r[:2] for r in usual] == [r[:2] for r in beyond] and len(usual) > 100
    for a, b in zip(usual, beyond):
        assert a[2:] == pytest.approx(b[2:], abs=0.011)
