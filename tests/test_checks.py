"""User checks and the brand-map size guard."""

import datetime as dt

import pytest

from brandflow.checks import panel_checks
from brandflow.functions import Periods
from brandflow.operators import classify
from brandflow.sources import brand_map_from_rows, bucket_names, checked_map, map_profile, read_brand_map, write_brand_map
from brandflow.sources.stores import scratch_path, scratch_root
from panel import PERIODS, households_df, purchases_df


def test_panel_checks_count_each_condition(spark):
    p = purchases_df(spark, ["1:A:19960105:10", "1:B:19970105:-4", "2:A:19960105:3"])
    hh = households_df(spark, ["1:1", "1:0.5", "2:1"])
    bm = brand_map_from_rows(spark, [("A", "A"), ("A", "C"), ("B", "B")])
    overlapping = Periods(dt.date(1996, 1, 1), dt.date(1996, 12, 31), dt.date(1996, 6, 1), dt.date(1997, 6, 1))
    assert panel_checks(p, hh, bm, overlapping) == {
        "brands_mapped_twice": 1,
        "negative_spend_rows": 1,
        "periods_overlap": True,
        "households_listed_twice": 1,
    }
    assert panel_checks(p, None, bm, PERIODS)["periods_overlap"] is False


def test_brand_map_guard(spark):
    bm = brand_map_from_rows(spark, [(f"b{i}", f"g{i % 3}") for i in range(10)])
    prof = map_profile(bm)
    assert prof.n_rows == 10 and bucket_names(bm) == ["REST", "g0", "g1", "g2"]
    assert sorted(prof.local.collect()) == sorted(bm.collect())
    big = brand_map_from_rows(spark, [(f"b{i}", "g") for i in range(10)])
    assert "ResolvedHint" not in checked_map(big, max_rows=5)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in checked_map(big, max_rows=50)._jdf.queryExecution().analyzed().toString().lower()


def test_classify_takes_any_number_of_buckets(spark):
    bm = brand_map_from_rows(spark, [(f"b{i}", f"g{i}") for i in range(10_001)])
    p = purchases_df(spark, ["1:b10000:19960105:10", "1:nowhere:19970105:4"])
    assert sorted(r["brand"] for r in classify(p, bm, PERIODS).collect()) == ["REST", "g10000"]


@pytest.mark.parametrize("row", [(None, "g"), ("b", None)])
def test_stored_brand_map_rejects_nulls(spark, row):
    path = scratch_path(spark, "not-null-map")
    write_brand_map(brand_map_from_rows(spark, [("a", "g")]), path)
    bad = spark.createDataFrame([("c", "g"), row], "brand string, aggregation string")
    with pytest.raises(Exception, match="NOT NULL"):
        write_brand_map(bad, path, mode="append")
    assert read_brand_map(spark, path).collect() == [("a", "g")]


def test_scratch_folder_is_required_on_a_cluster():
    class Session:  # a session on a cluster, without the setting
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session)
