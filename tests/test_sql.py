"""The analysis called from SQL: default dates, named arguments, session variables."""

import pytest
from panel import AB_MAP, PERIODS, households_df, purchases_df
from pyspark.sql import functions as F

from brandflow.functions import Periods, parse_yyyymmdd
from brandflow.plans import declare_periods, gain_loss, register_gain_loss
from brandflow.sources import brand_map_from_rows, tpch

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def panel(spark):
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=False)
    hh = hh.unionByName(hh.where("hhkey % 7 = 0"))  # some households twice
    register_gain_loss(spark, p, hh, bm, periods=per)
    return p, hh, bm, per


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_call_with_defaults_equals_v6(spark, panel):
    want = rows(gain_loss(*panel))
    assert len(want) > 100 and rows(spark.sql("SELECT * FROM gain_loss() ORDER BY B1, B2")) == want


def test_named_arguments_and_session_variables(spark, panel):
    p, hh, bm, _ = panel
    other = Periods.years(1995, 1996)
    want = rows(gain_loss(p, hh, bm, other))
    named = ", ".join(f"{k} => DATE'{v}'" for k, v in vars(other).items())
    assert rows(spark.sql(f"SELECT * FROM gain_loss({named}) ORDER BY B1, B2")) == want
    declare_periods(spark, panel[3])
    spark.sql("SET VAR start_p1 = DATE'1995-01-01', end_p1 = DATE'1995-12-31', start_p2 = DATE'1996-01-01', end_p2 = DATE'1996-12-31'")
    assert rows(spark.sql("SELECT * FROM gain_loss(start_p1, end_p1, start_p2, end_p2) ORDER BY B1, B2")) == want


def test_it_is_a_table_like_others(spark, panel):
    top = spark.sql("SELECT B1, sum(total_gains_b1_to_b2) AS g FROM gain_loss() WHERE B1 <> B2 GROUP BY B1 HAVING g > 0 ORDER BY g DESC LIMIT 3")
    assert top.count() == 3
    plan = spark.sql("SELECT * FROM gain_loss()")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "PythonUDF" not in plan


def test_edges_as_in_the_functions(spark):
    """NULL brands, dates, values and weights, zero totals, a brand mapped twice, overlapping periods."""
    p = purchases_df(
        spark,
        ["1:A:19960105:10", "1:B:19970105:-10", "1:NULL:19970107:3", "1:Z:NULL:4", "2:A:19960105:NULL", "2:A:19970105:5", "3:A:19960301:1", "3:B:19960301:-1", "3:A:19970301:2", "4:C:19960101:7"],
    )
    hh = households_df(spark, ["1:1", "1:0.5", "2:2", "3:1", "3:NULL", "4:0"])
    bm = brand_map_from_rows(spark, [*AB_MAP, ("A", "A2"), ("C", "B")])
    dated = p.withColumn("datep", parse_yyyymmdd(F.col("datep")))
    for per in (PERIODS, Periods(PERIODS.start_p1, PERIODS.end_p2, PERIODS.start_p2, PERIODS.end_p2)):
        register_gain_loss(spark, dated, hh, bm, name="edge_gain_loss", periods=per)
        assert rows(spark.sql("SELECT * FROM edge_gain_loss() ORDER BY B1, B2")) == rows(gain_loss(dated, hh, bm, per))
