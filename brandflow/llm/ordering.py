"""Neighbours in a total order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written


def successors(rows: DataFrame, order: list[Column], values: list[str], wrap: bool = False) -> DataFrame:
    """``rows`` with next_<value>: that value of the row that follows in ``order``; null, or the first's if ``wrap``, after the last.

    Rows are dealt out by ranges; each task looks ahead in its range, and a table
    with one row per range gives what follows its last row. ``order`` should
    leave no ties: the order of equal rows is arbitrary.
    """
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("range").orderBy(*order)
    ahead = dealt.select("*", *[F.lead(F.struct(v)).over(within).alias(f"_next_{v}") for v in values])
    first = dealt.withColumn("_place", F.row_number().over(within)).where("_place = 1").select("range", F.struct(*values).alias("_head"))
    ranges = Window.orderBy("range")  # one row a range
    heads = first.select("range", F.lead("_head").over(ranges).alias("_after"), F.first("_head").over(ranges).alias("_very_first"))
    follows = F.coalesce("_after", "_very_first") if wrap else F.col("_after")
    heads = heads.select("range", follows.alias("_follows"))
    out = ahead.join(heads, "range")
    return out.select(
        *rows.columns, *[F.when(F.col(f"_next_{v}").isNotNull(), F.col(f"_next_{v}")[v]).otherwise(F.col("_follows")[v]).alias(f"next_{v}") for v in values]
    )


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place in ``order``, from 0, as column ``name``. ``order`` should leave no ties."""
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id()), "ranges")
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = dealt.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return dealt.withColumn("_place", place).join(before, "range").select(*rows.columns, (F.col("_before") + F.col("_place")).alias(name))
