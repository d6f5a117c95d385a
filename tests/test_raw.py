"""Raw table readers: explicit schema, pruned columns, several formats."""

import pytest

from brandflow.plans import gain_loss
from brandflow.sources import read_households, read_purchases, tpch
from brandflow.sources.stores import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_raw_files_give_the_same_matrix(spark, fmt):
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=True)
    base = scratch_path(spark, f"raw-{fmt}")
    writer_opts = {"header": "true"} if fmt == "csv" else {}
    p.withColumn("extra", p.hhkey * 2).write.format(fmt).options(**writer_opts).save(f"{base}/purchases")
    hh.write.format(fmt).options(**writer_opts).save(f"{base}/households")
    rp = read_purchases(spark, f"{base}/purchases", fmt)
    rh = read_households(spark, f"{base}/households", fmt)
    assert rp.columns == p.columns and dict(rp.dtypes)["datep"] == "string"
    want = gain_loss(p, hh, bm, per, variant="v1").collect()
    got = gain_loss(rp, rh, bm, per, variant="v1").collect()
    assert got == want
