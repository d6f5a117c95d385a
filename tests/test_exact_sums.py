"""Sums that don't depend on the order of the rows: bit for bit, for every variant."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from brandflow.functions import exact_sum, plain_sum
from brandflow.operators.matrix import flow_sums
from brandflow.plans import VARIANTS, allocated_spend
from brandflow.sources import tpch, weighted_purchases

SF = "/root/testdata/sf0.001"


def bits(x):
    return None if x is None else struct.pack(">d", x)


def values(seed, n=4000):
    rng = random.Random(seed)
    return [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-12, 12) for _ in range(n)]


def test_any_order_gives_the_same_bits_and_the_true_sum(spark):
    rows = [(k % 3, x) for k, x in enumerate(values(1))]
    seen = set()
    for seed, parts in ((0, 1), (1, 3), (2, 7), (3, 16)):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "g int, x double").repartition(parts)
        out = df.groupBy("g").agg(exact_sum("x").alias("s"), plain_sum("x").alias("p"))
        seen.add(tuple((r["g"], bits(r["s"])) for r in out.orderBy("g").collect()))
    assert len(seen) == 1
    for g, b in seen.pop():
        true = sum(Fraction(x) for k, x in rows if k == g)
        assert abs(Fraction(struct.unpack(">d", b)[0]) - true) <= abs(true) * Fraction(1, 2**51) + Fraction(len(rows), 2**60)


def test_cancellation_keeps_the_small_part(spark):
    df = spark.createDataFrame([(1e15,), (2.0**-50,), (-1e15,), (0.1,)], "x double")
    assert df.agg(exact_sum("x")).first()[0] == 0.1 + 2.0**-50


@pytest.mark.parametrize(
    "xs, want",
    [([], None), ([None], None), ([None, 1.5], 1.5), ([0.0, -0.0], 0.0), ([math.inf, 1.0], math.inf), ([1e300, 1e300], 2e300), ([-1e19, 1.0], -1e19 + 1.0)],
)
def test_null_and_values_beyond_the_grid_as_with_sum(spark, xs, want):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert df.agg(exact_sum("x")).first()[0] == want
    windowed = df.select(exact_sum("x", Window.partitionBy(F.lit(1))).alias("s")).collect()
    assert [r["s"] for r in windowed] == [want] * len(xs)


def test_nan_and_opposite_infinities(spark):
    for xs in ([math.nan, 1.0], [math.inf, -math.inf]):
        df = spark.createDataFrame([(x,) for x in xs], "x double")
        assert math.isnan(df.agg(exact_sum("x")).first()[0])


@pytest.mark.parametrize("name", list(VARIANTS))
def test_variants_are_bit_equal_under_shuffled_partitions(spark, name):
    """Unrounded cells, with purchases and households in other orders and partitions."""
    v = VARIANTS[name]
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=v.source == "raw")
    hh = hh.unionByName(hh.where("hhkey % 5 = 0").withColumn("continuo", F.col("continuo") * 0.3))  # copies: sums of weights too
    seen, plain = set(), []
    for seed, parts in ((11, 2), (12, 13)):
        rows = p.orderBy(F.rand(seed)).repartition(parts)
        weights = hh.orderBy(F.rand(seed)).repartition(parts)
        if v.source == "weighted_store":
            rows, weights = weighted_purchases(rows, weights, exact=True), None
        allocated = allocated_spend(rows, weights, bm, per, v, materialize="none", exact=True)
        cells = flow_sums(allocated, max_buckets=10_000, block=4, total=exact_sum).collect()
        seen.add(tuple(sorted((r["B1"], r["B2"], bits(r["gains"]), bits(r["losses"]), r["n_households"]) for r in cells)))
        plain.append({(r["B1"], r["B2"]): r["gains"] for r in cells})
    assert len(seen) == 1
    if name not in ("v3", "v7"):
        return  # the plain sums of the others are compared with one another elsewhere
    p, _, _, _ = tpch.panel(spark, SF, string_dates=v.source == "raw")
    if v.source == "weighted_store":
        p, hh = weighted_purchases(p, hh), None
    usual = {(r["B1"], r["B2"]): r["gains"] for r in flow_sums(allocated_spend(p, hh, bm, per, v, materialize="none")).collect()}
    assert usual.keys() == plain[0].keys()
    for cell, gains in usual.items():
        assert gains == pytest.approx(plain[0][cell], rel=1e-9, abs=1e-9)
