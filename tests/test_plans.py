"""Physical plan shape: pushdown, bounded broadcasts, no pair expansion, one household shuffle."""

import os
import random

import pytest

from brandflow.operators import gain_loss_matrix
from brandflow.operators.matrix import flow_sums
from brandflow.plans import VARIANTS, allocated_spend, gain_loss
from brandflow.sources import bucket_names, read_purchase_store, reference_brand_map, tpch
from brandflow.sources import stores
from brandflow.sources.stores import scratch_path, write_purchase_store

SF = "/root/testdata/sf0.001"


def _plan(df):
    """The executed (final adaptive) plan, without the initial plan AQE appends."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def store(spark):
    p = tpch.purchases(spark, SF, string_dates=True)
    path = scratch_path(spark, "plan-store")
    return write_purchase_store(p, path, table="brandflow_plan_test_store")


def test_store_scan_prunes_months_and_columns(spark, store):
    _, hh, bm, per = tpch.panel(spark, SF)
    df = gain_loss(read_purchase_store(spark, store), hh, bm, per, variant="v3")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "store" in line][0]
    assert "PartitionFilters: [" in scan and "month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    # only the columns the stage needs are read
    schema = scan.split("ReadSchema: ")[1]
    assert "occaskey" not in schema and "rwkorr" not in schema


def test_no_pair_expansion_and_one_household_shuffle(spark):
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=False)
    alloc = allocated_spend(p, hh, bm, per, VARIANTS["v6"])  # C3 written bucketed by hhkey
    df = gain_loss_matrix(alloc)
    df.collect()
    plan = _plan(df)
    assert "SortMergeJoin" not in plan  # no self-join of household rows
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # both windows read the bucketed C3 without any shuffle on hhkey
    assert plan.count("hashpartitioning(hhkey") == 0
    assert plan.count("Window") >= 1
    # the pairs of a household go straight into the partial aggregate: no exchange between explode and it
    lines = plan.splitlines()
    aggregate = next(k for k, line in enumerate(lines) if "partial_sum" in line)
    explode = next(k for k, line in enumerate(lines) if k > aggregate and "Generate explode" in line)
    assert not any("Exchange" in line for line in lines[aggregate + 1 : explode])
    # with the checkpoint instead, the windows share one shuffle on hhkey
    alloc = allocated_spend(p, hh, bm, per, VARIANTS["v6"], materialize="checkpoint")
    df = gain_loss_matrix(alloc)
    df.collect()
    assert _plan(df).count("hashpartitioning(hhkey") == 1


def test_brand_map_and_factors_are_broadcast(spark):
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=False)
    df = gain_loss(p, hh, bm, per, variant="v6", materialize="none")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


@pytest.mark.parametrize("n_buckets", [3, 200])
def test_matrix_equals_brute_force(spark, n_buckets):
    rnd = random.Random(n_buckets)
    rows, want, pairs = [], {}, {}
    for h in range(60):
        held = rnd.sample(range(n_buckets), rnd.randrange(1, min(12, n_buckets) + 1))
        c = rnd.choice([0.0, 2.0, 5.0, None])
        own = [(f"b{b:03d}", rnd.choice([None, 0.0, rnd.random()]), rnd.choice([None, rnd.random()])) for b in held]
        rows += [(h, b, q1, q2, c) for b, q1, q2 in own]
        for x, x1, x2 in own:
            for y, y1, y2 in own:
                f = lambda q: q / c if c and q is not None else 0.0
                cell = want.setdefault((x, y), [None, None])
                for k, term in enumerate((None if y1 is None else y1 * f(x2), None if x1 is None else x1 * f(y2))):
                    if term is not None:
                        cell[k] = (cell[k] or 0.0) + term
                pairs[x, y] = pairs.get((x, y), 0) + 1
    alloc = spark.createDataFrame(rows, "hhkey long, brand string, cseg_p1 double, cseg_p2 double, cseg double")
    got = {(r["B1"], r["B2"]): r for r in flow_sums(alloc.repartition(5)).collect()}
    assert got.keys() == want.keys()
    for cell, (gains, losses) in want.items():
        assert got[cell]["n_households"] == pairs[cell]
        for name, w in (("gains", gains), ("losses", losses)):
            assert got[cell][name] is None if w is None else got[cell][name] == pytest.approx(w, abs=1e-12)


def test_more_shuffle_partitions_than_spark_allows_buckets(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "100001")
    limit, stores.MAX_TABLE_BUCKETS = stores.MAX_TABLE_BUCKETS, 16  # as on a cluster, with fewer files
    try:
        assert stores.shuffle_partitions(spark) == 100001
        df = spark.createDataFrame([(1, 2.0)], "hhkey long, x double")
        assert stores.materialize_by_household(df, "c3", partitioned=True).collect() == df.collect()
    finally:
        stores.MAX_TABLE_BUCKETS = limit
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert limit <= 100_000


def test_reference_brand_map(spark):
    m = reference_brand_map(spark)
    assert m.count() == 23
    names = bucket_names(m)
    assert len(names) == 22 and "REST" in names and "FACHHANDEL" in names
    assert [f.nullable for f in m.schema.fields] == [False, False]


def test_scratch_tables_can_be_dropped(spark):
    from brandflow.sources import drop_scratch_tables

    p, hh, bm, per = tpch.panel(spark, SF, string_dates=False)
    gain_loss(p, hh, bm, per, variant="v6").collect()
    spark.range(1).write.saveAsTable("brandflow_c3_of_another_run", mode="overwrite")
    paths = [path for own in stores._OWN_TABLES.values() for _, path in own]
    assert paths and all(os.path.isdir(p) for p in paths)
    assert drop_scratch_tables(spark) == len(paths)
    assert not any(os.path.exists(p) for p in paths)
    assert spark.catalog.tableExists("brandflow_c3_of_another_run")
    spark.sql("DROP TABLE brandflow_c3_of_another_run")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("brandflow_c3_")]


def test_purchases_are_scanned_once_per_analysis(spark, store):
    # the C3 job reads the store; the job after it reads only the C3 table
    _, hh, bm, per = tpch.panel(spark, SF)
    df = gain_loss(read_purchase_store(spark, store), hh, bm, per, variant="v6")
    df.collect()
    plan = _plan(df)
    assert "brandflow_c3_" in plan
    assert "brandflow_plan_test_store" not in plan


def test_pre_weighted_path_has_no_household_shuffle_after_c3(spark):
    from brandflow.sources import weighted_purchases

    p, hh, bm, per = tpch.panel(spark, SF, string_dates=False)
    df = gain_loss(weighted_purchases(p, hh), None, bm, per, variant="v7")
    df.collect()
    plan = _plan(df)
    assert "brandflow_c3_" in plan and plan.count("hashpartitioning(hhkey") == 0
