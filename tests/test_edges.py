"""Edge panels (FIXTURES.md section 3) for each family of variants."""

import pytest

from panel import run

V1 = ["v1", "v2"]
V3 = ["v3"]
V4P = ["v4", "v5", "v6", "v7"]
ALL = V1 + V3 + V4P


def zeros(*cells):
    return {c: (0.0, 0.0) for c in cells}


@pytest.mark.parametrize("v", ALL)
def test_full_switch(spark, v):
    got = run(spark, v, ["1:A:19960105:10", "1:B:19970105:10"], ["1:1"])
    assert got == {("B", "A"): (10.0, 0.0), ("A", "B"): (0.0, 10.0), **zeros(("A", "A"), ("B", "B"))}


@pytest.mark.parametrize("v", ALL)
def test_brand_only_out_of_period(spark, v):
    got = run(spark, v, ["1:A:19960105:10", "1:A:19970105:10", "1:B:20000105:5"], ["1:1"])
    expected = {("A", "A"): (10.0, 10.0)}
    if v in V1:
        expected.update(zeros(("A", "B"), ("B", "A"), ("B", "B")))
    assert got == expected


@pytest.mark.parametrize("v", ALL)
def test_zero_value_brand(spark, v):
    got = run(spark, v, ["1:A:19960105:10", "1:A:19970105:10", "1:B:19960105:0"], ["1:1"])
    expected = {("A", "A"): (10.0, 10.0)}
    if v in V1 + V3:
        expected.update(zeros(("A", "B"), ("B", "A"), ("B", "B")))
    assert got == expected


@pytest.mark.parametrize("v", ALL)
def test_household_weight_zero_still_counts_in_factor(spark, v):
    got = run(
        spark, v, ["1:A:19960105:10", "1:A:19970105:10", "2:A:19960105:30", "2:B:19970105:30"], ["1:1", "2:0"]
    )
    assert got == {("A", "A"): (10.0, 10.0)}


@pytest.mark.parametrize("v", ALL)
def test_household_weight_null(spark, v):
    got = run(spark, v, ["1:A:19960105:10", "1:A:19970105:10", "2:A:19960105:30"], ["1:1", "2:NULL"])
    assert got == {("A", "A"): (10.0, 10.0)}


@pytest.mark.parametrize("v", ALL)
def test_household_missing(spark, v):
    got = run(spark, v, ["1:A:19960105:10", "1:A:19970105:10", "9:A:19960105:30"], ["1:1"])
    assert got == {("A", "A"): (10.0, 10.0)}


@pytest.mark.parametrize("v", ALL)
def test_one_period_only(spark, v):
    got = run(spark, v, ["1:A:19960105:10"], ["1:1"])
    assert got == {("A", "A"): (0.0, 0.0)}


@pytest.mark.parametrize("v", ALL)
def test_null_and_unmapped_brand(spark, v):
    got = run(spark, v, ["1:NULL:19960105:10", "1:Z:19970105:10"], ["1:1"])
    assert got == {("REST", "REST"): (10.0, 10.0)}


@pytest.mark.parametrize("v", ALL)
def test_refund(spark, v):
    got = run(spark, v, ["1:A:19960105:10", "1:B:19970105:-4"], ["1:1"])
    assert got == {("B", "A"): (-4.0, 0.0), ("A", "B"): (0.0, -4.0), **zeros(("A", "A"), ("B", "B"))}


@pytest.mark.parametrize("v", ALL)
def test_null_value(spark, v):
    got = run(spark, v, ["1:A:19960105:NULL", "1:B:19960105:4", "1:B:19970105:4"], ["1:1"])
    expected = {("B", "B"): (4.0, 4.0)}
    if v in V1 + V3:
        expected.update({("A", "A"): (None, None), ("A", "B"): (0.0, None), ("B", "A"): (None, 0.0)})
    assert got == expected


@pytest.mark.parametrize("v", ALL)
def test_duplicate_household(spark, v):
    got = run(spark, v, ["1:A:19960105:10", "1:B:19970105:10"], ["1:1", "1:1"])
    assert got == {("B", "A"): (20.0, 0.0), ("A", "B"): (0.0, 20.0), **zeros(("A", "A"), ("B", "B"))}


@pytest.mark.parametrize("v", ALL)
def test_duplicate_map_key(spark, v):
    got = run(
        spark, v, ["1:A:19960105:10", "1:B:19970105:10"], ["1:1"], brand_map=[("A", "A"), ("A", "C"), ("B", "B")]
    )
    assert got == {
        ("B", "A"): (5.0, 0.0),
        ("B", "C"): (5.0, 0.0),
        ("A", "B"): (0.0, 5.0),
        ("C", "B"): (0.0, 5.0),
        **zeros(("A", "A"), ("A", "C"), ("C", "A"), ("C", "C"), ("B", "B")),
    }


@pytest.mark.parametrize("v", ["v1", "v6"])
def test_overlapping_periods_count_in_period_one(spark, v):
    from brandflow.functions import Periods
    import datetime as dt

    periods = Periods(dt.date(1996, 1, 1), dt.date(1996, 12, 31), dt.date(1996, 6, 1), dt.date(1997, 12, 31))
    # 1996-07-01 is in both periods and counts in period 1 only.
    got = run(spark, v, ["1:A:19960701:10", "1:B:19970105:10"], ["1:1"], periods=periods)
    assert got[("B", "A")] == (10.0, 0.0)


def test_malformed_date_raises(spark):
    with pytest.raises(Exception, match="malformed purchase date"):
        run(spark, "v1", ["1:A:19960230:10", "1:B:19970105:10"], ["1:1"])


def test_null_date_is_period_three_in_v1_and_filtered_later(spark):
    p = ["1:A:19960105:10", "1:A:19970105:10", "1:B:NULL:5"]
    assert run(spark, "v1", p, ["1:1"]) == {("A", "A"): (10.0, 10.0), **zeros(("A", "B"), ("B", "A"), ("B", "B"))}
    assert run(spark, "v6", p, ["1:1"]) == {("A", "A"): (10.0, 10.0)}
