"""Stores that stay sorted: merged drops, interrupted changes, new weights, look-ups by household."""

import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from brandflow.plans import gain_loss
from brandflow.sources import compact_months, drop_old_months, household_history, merge_rows, month_locations, tpch, update_weights
from brandflow.sources import months as module
from brandflow.sources import weighted_purchases, write_purchase_store, write_weighted_store
from brandflow.sources.stores import scratch_path
from brandflow.streaming import start_clustered_stream

SF = "/root/testdata/sf0.001"
COLUMNS = ["hhkey", "occaskey", "brand", "datep", "value", "brandfactor"]


@pytest.fixture
def table(spark):
    names = []

    def new(write, *rows, **options):
        names.append(f"brandflow_months_{len(names)}")
        spark.sql(f"DROP TABLE IF EXISTS {names[-1]}")
        return write(*rows, scratch_path(spark, "months"), table=names[-1], **options)

    yield new
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def drops(p, n=3):
    return [p.where(F.pmod(F.col("occaskey"), F.lit(n)) == k) for k in range(n)]


def contents(df, columns=COLUMNS):
    return sorted(map(str, df.select(columns).collect()))


def files(spark, name):
    return [f for place in month_locations(spark, name).values() for f in glob.glob(place.removeprefix("file:") + "/*.parquet")]


def all_sorted(paths):
    for f in paths:
        rows = [tuple(r.values()) for r in pq.read_table(f, columns=["hhkey", "brand", "datep"], partitioning=None).to_pylist()]
        assert rows == sorted(rows)


def test_streamed_drops_leave_sorted_whole_months(spark, table):
    raw = tpch.purchases(spark, SF)
    dated = tpch.purchases(spark, SF, string_dates=False)
    parts, source = drops(raw, 4), scratch_path(spark, "drops")
    name = table(write_purchase_store, parts[0])
    checkpoint = scratch_path(spark, "clustered-ckpt")
    for k in (1, 2, 3):
        parts[k].write.parquet(f"{source}/drop={k}")
        start_clustered_stream(spark, f"{source}/*", name, checkpoint).awaitTermination()
        assert spark.table(name).count() == raw.where(F.pmod(F.col("occaskey"), F.lit(4)) <= k).count()
    start_clustered_stream(spark, f"{source}/*", name, checkpoint).awaitTermination()  # nothing new
    assert contents(spark.table(name)) == contents(dated)
    all_sorted(files(spark, name))
    assert len(files(spark, name)) <= 1.5 * len(month_locations(spark, name))  # compact, whatever the number of drops
    pruned = spark.table(name).where("month = DATE'1996-03-01'")
    assert len(pruned.inputFiles()) <= 2


def test_a_change_runs_again_without_doubling(spark, table, monkeypatch):
    first, second = drops(tpch.purchases(spark, SF, string_dates=False), 2)
    name = table(write_purchase_store, first)
    before = spark.table(name).count()
    real, switched = spark.sql, []

    def failing(text, *args):
        if text.startswith("ALTER TABLE"):
            if len(switched) == 5:
                raise RuntimeError("the driver is lost")
            switched.append(text)
        return real(text, *args)

    monkeypatch.setattr(type(spark), "sql", lambda self, text, *args: failing(text, *args))
    with pytest.raises(RuntimeError):
        merge_rows(second, name, "drop-7")
    monkeypatch.undo()
    assert before < spark.table(name).count() < before + second.count()
    merge_rows(second, name, "drop-7")
    assert contents(spark.table(name)) == contents(first.unionByName(second))
    assert merge_rows(second, name, "drop-7") == []
    all_sorted(files(spark, name))


def test_readers_keep_the_months_they_planned_with(spark, table):
    first, second = drops(tpch.purchases(spark, SF, string_dates=False), 2)
    name = table(write_purchase_store, first)
    planned = spark.read.parquet(*month_locations(spark, name).values())
    n = planned.count()
    merge_rows(second, name, "one")
    assert planned.count() == n  # the old files are still there
    merge_rows(second.limit(10), name, "two")
    kept = contents(spark.table(name))
    assert drop_old_months(spark, name) > 0 and contents(spark.table(name)) == kept
    assert drop_old_months(spark, name) == 0


def test_compaction_of_appended_files_and_rows_without_a_date(spark, table):
    p = tpch.purchases(spark, SF, string_dates=False).withColumn("datep", F.when(F.col("occaskey") % 50 == 0, None).otherwise(F.col("datep")))
    parts = drops(p)
    name = table(write_purchase_store, parts[0])
    for part in parts[1:]:
        part.withColumn("month", F.trunc("datep", "month")).repartition(3).select(spark.table(name).columns).write.insertInto(name)
    many = len(files(spark, name))
    compact_months(spark, name)
    assert len(files(spark, name)) < many / 2 and None in month_locations(spark, name)
    assert contents(spark.table(name)) == contents(p)
    all_sorted(f for f in files(spark, name) if "HIVE_DEFAULT" not in f)


def test_new_weights_touch_their_months_only(spark, table):
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=False)
    name = table(write_weighted_store, p, hh)
    before = month_locations(spark, name)
    buyers = p.groupBy("hhkey").agg(F.collect_set(F.trunc("datep", "month")).alias("months")).orderBy(F.size("months"), "hhkey").limit(2).collect()
    chosen = [r["hhkey"] for r in buyers]
    # one household weighs more and is listed twice, one goes
    new = hh.where(~F.col("hhkey").isin(chosen)).unionByName(spark.createDataFrame([(chosen[0], 9.5), (chosen[0], 0.25)], hh.schema))
    months = update_weights(spark, name, p, hh, new)
    assert set(months) == {m for r in buyers for m in r["months"]} and 0 < len(months) < len(before)
    after = month_locations(spark, name)
    assert {m for m in after if after[m] != before[m]} == set(months)
    columns = ["hhkey", "brand", "datep", "spent_cs", "spent_fs"]
    assert contents(spark.table(name), columns) == contents(weighted_purchases(p, new), columns)
    all_sorted(files(spark, name))
    assert gain_loss(spark.table(name), None, bm, per, variant="v7").collect() == gain_loss(p, new, bm, per).collect()
    assert update_weights(spark, name, p, new, new) == []


def rows_read(df):
    """Rows that the scans of a query gave out, after what the Parquet reader skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, nodes = 0, [plan]
    while nodes:
        node = nodes.pop()
        if "FileScan" in node.nodeName() or node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        nodes += [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
    return total


def test_one_household_reads_a_few_pages(spark):
    # one month, many households: what a look-up skips lies within its files
    p = tpch.purchases(spark, "/root/testdata/sf0.1", string_dates=False).where("datep BETWEEN DATE'1996-03-01' AND DATE'1996-05-31'")
    path = write_purchase_store(p, scratch_path(spark, "indexed"), household_index=True, num_partitions=6)
    household = p.groupBy("hhkey").count().orderBy(F.desc("count")).first()
    found = household_history(spark, path, [household["hhkey"]])
    assert found.count() == household["count"]
    assert rows_read(found) < 0.3 * p.count()
    every = re.findall(r"In\(hhkey|EqualTo\(hhkey", found._jdf.queryExecution().executedPlan().toString())
    assert every  # pushed to the reader


def test_module_has_one_writer_only():
    assert "overwrite" not in open(module.__file__).read()  # nothing is ever written over
