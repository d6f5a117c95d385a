"""The application entry point on files written from the derived panel."""

import datetime as dt

import pytest

from brandflow import app
from brandflow.plans import gain_loss
from brandflow.sources import tpch, write_brand_map
from brandflow.sources.stores import scratch_path

SF = "/root/testdata/sf0.001"


def test_app_runs_each_source_kind(spark):
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=True)
    base = scratch_path(spark, "app")
    p.write.parquet(f"{base}/purchases")
    hh.write.parquet(f"{base}/households")
    write_brand_map(bm, f"{base}/map")
    want = gain_loss(p, hh, bm, per, variant="v6").collect()
    common = ["--purchases", f"{base}/purchases", "--households", f"{base}/households", "--brand-map", f"{base}/map",
              "--p1", "1996-01-01", "1996-12-31", "--p2", "1997-01-01", "1997-12-31"]
    got = app.run(spark, app.parse_args(common + ["--variant", "v6", "--build-store", f"{base}/store"])).collect()
    assert got == want
    got7 = app.run(spark, app.parse_args(common + ["--variant", "v7", "--build-store", f"{base}/wstore"])).collect()
    assert got7 == want
    raw1 = app.run(spark, app.parse_args(common + ["--variant", "v1"])).collect()
    nonzero = {(r[0], r[1]): (r[2], r[3]) for r in raw1 if (r[2], r[3]) != (0.0, 0.0)}
    assert nonzero == {(r[0], r[1]): (r[2], r[3]) for r in want if (r[2], r[3]) != (0.0, 0.0)}


def test_one_period_alone_is_an_error():
    for lone in (["--p1", "1996-01-01", "1996-12-31"], ["--p2", "1997-01-01", "1997-12-31"]):
        with pytest.raises(SystemExit):
            app.parse_args(lone)


def test_every_cell_is_printed(spark, capsys, monkeypatch):
    cells = spark.range(20_000).selectExpr("id AS B1", "id AS B2")
    monkeypatch.setattr(app, "run", lambda *a: cells)
    app.main([])
    assert len(capsys.readouterr().out.splitlines()) == 20_001


def test_default_periods_are_the_reference_years():
    args = app.parse_args([])
    assert args.p1 is None and args.variant == "v6"
    from brandflow.functions import Periods

    assert Periods().start_p1 == dt.date(2019, 1, 1) and Periods().end_p2 == dt.date(2020, 12, 31)
