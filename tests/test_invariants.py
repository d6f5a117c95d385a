"""Invariants of the matrix on the TPC-H-derived panel, and variant agreement."""

import pytest
from pyspark.sql import functions as F

from brandflow.operators import cseg_allocation_window, household_cseg
from brandflow.plans import VARIANTS, allocated_spend, gain_loss
from brandflow.sources import read_purchase_store, read_weighted_store, tpch
from brandflow.sources.stores import scratch_path, write_purchase_store, write_weighted_store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def panel(spark):
    return tpch.panel(spark, SF, string_dates=True)


@pytest.fixture(scope="module")
def stores(spark, panel):
    p, hh, _, _ = panel
    ps = write_purchase_store(p, scratch_path(spark, "test-purchase-store"))
    ws = write_weighted_store(p, hh, scratch_path(spark, "test-weighted-store"))
    return read_purchase_store(spark, ps), read_weighted_store(spark, ws)


@pytest.fixture(scope="module")
def results(spark, panel, stores):
    p, hh, bm, per = panel
    out = {}
    for name, v in VARIANTS.items():
        src = p if v.source == "raw" else stores[0] if v.source == "purchase_store" else stores[1]
        out[name] = {(r[0], r[1]): (r[2], r[3]) for r in gain_loss(src, hh if v.source != "weighted_store" else None, bm, per, variant=name).collect()}
    return out


def test_mirror_symmetry(results):
    for cells in results.values():
        for (b1, b2), (_, loss) in cells.items():
            assert loss == cells[(b2, b1)][0]


def test_variants_agree_on_non_zero_cells(results):
    def nonzero(cells):
        return {k: v for k, v in cells.items() if v != (0.0, 0.0)}

    base = nonzero(results["v6"])
    assert len(base) > 0
    for name, cells in results.items():
        nz = nonzero(cells)
        assert set(nz) == set(base), name
        for k, (g, l) in nz.items():
            assert abs(g - base[k][0]) <= 0.011 and abs(l - base[k][1]) <= 0.011, (name, k)


def test_conservation(spark, panel, results):
    # total gains = sum over households of cseg (non-negative spend)
    p, hh, bm, per = panel
    alloc = allocated_spend(p, hh, bm, per, VARIANTS["v6"])
    total_cseg = household_cseg(alloc.select("hhkey", "brand", "spent_p1", "spent_p2")).agg(F.sum("cseg")).first()[0]
    gains = sum(g for g, _ in results["v6"].values())
    assert abs(gains - total_cseg) <= 0.006 * len(results["v6"]) + 1e-6 * total_cseg


def test_single_period_households_add_nothing(spark, panel):
    p, hh, bm, per = panel
    alloc = cseg_allocation_window(
        allocated_spend(p, hh, bm, per, VARIANTS["v6"]).select("hhkey", "brand", "spent_p1", "spent_p2")
    )
    one_period = alloc.where("cseg = 0")
    assert one_period.where("cseg_p1 != 0 OR cseg_p2 != 0").count() == 0
