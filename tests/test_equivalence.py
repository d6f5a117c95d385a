"""The same matrix whatever the physical choices: materialization and store layout."""

from brandflow.plans import gain_loss
from brandflow.sources import read_purchase_store, tpch
from brandflow.sources.stores import scratch_path, write_purchase_store

SF = "/root/testdata/sf0.001"


def test_materialization_and_layout_do_not_change_the_matrix(spark):
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=True)
    want = gain_loss(p, hh, bm, per, variant="v6", materialize="none").collect()
    for mode in ("table", "checkpoint"):
        assert gain_loss(p, hh, bm, per, variant="v6", materialize=mode).collect() == want
    for granularity in ("month", "day"):
        store = write_purchase_store(p, scratch_path(spark, f"eq-{granularity}"), granularity=granularity)
        got = gain_loss(read_purchase_store(spark, store), hh, bm, per, variant="v6").collect()
        assert got == want
