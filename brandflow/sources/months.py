"""Months of a catalog store, replaced as a whole: written beside the old ones, then switched in the catalog.

A store registered as a table (``write_purchase_store(..., table=...)``) has one
location for each month. New rows for a month are merged with those it holds, sorted
by household as in the first write, and written into a folder of their own; then the
month's location is set to it. A query sees the old month or the new one, never a
part: it takes the location when it is planned, and the old folder stays until
``drop_old_months``. Every change has a tag that is part of the folders' names; a
month whose location carries the tag has it already, so a change that was
interrupted can be run again and does what is left. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact_sum
from ..operators.spend import household_weights
from .stores import MONTH, scratch_path, weighted_purchases, write_clustered

Month = dt.date | None


def _spec(month: Month) -> str:
    return f"{MONTH} = " + ("null" if month is None else f"DATE'{month.isoformat()}'")


def month_locations(spark: SparkSession, table: str) -> dict[Month, str]:
    """Folder of each month of a catalog store."""
    state = spark._jsparkSession.sessionState()
    parts = state.catalog().listPartitions(state.sqlParser().parseTableIdentifier(table), spark.sparkContext._jvm.scala.Option.empty())
    out: dict[Month, str] = {}
    for k in range(parts.size()):
        value = parts.apply(k).spec().apply(MONTH)
        known = value is not None and value != "__HIVE_DEFAULT_PARTITION__"
        out[dt.date.fromisoformat(value) if known else None] = parts.apply(k).location().toString()
    return out


def _root(spark: SparkSession, table: str) -> str:
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return rows["Location"].rstrip("/")


def _in_months(months: list[Month]) -> F.Column:
    named = [m for m in months if m is not None]
    some = F.col(MONTH).isin(named) if named else F.lit(False)
    return some | F.col(MONTH).isNull() if None in months else some


def replace_months(rows: DataFrame, table: str, months: list[Month], tag: str) -> None:
    """Make ``rows`` (with ``month``) all that the given months hold; other months keep their files. Months without rows become empty."""
    spark = rows.sparkSession
    folder = f"{_root(spark, table)}/changes/{tag}-{uuid.uuid4().hex}"
    known = month_locations(spark, table)
    write_clustered(rows.select(*[c for c in spark.table(table).columns if c != MONTH], MONTH), folder, MONTH)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for month in months:
        place = f"{folder}/{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month.isoformat()}"
        fs.mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place))  # there already, unless the month became empty
        if month in known:
            spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(month)}) SET LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({_spec(month)}) LOCATION '{place}'")
    spark.catalog.refreshTable(table)


def merge_rows(rows: DataFrame, table: str, tag: str) -> list[Month]:
    """Add ``rows`` (the store's columns but ``month``) to their months; returns the months that were changed.

    Months that already have the change ``tag`` are left as they are.
    """
    spark = rows.sparkSession
    spark.catalog.refreshTable(table)
    rows = rows.withColumn(MONTH, F.trunc("datep", "month"))
    done = {m for m, place in month_locations(spark, table).items() if f"/changes/{tag}-" in place}
    months = [r[0] for r in rows.select(MONTH).distinct().collect() if r[0] not in done]  # one row a month
    if months:
        held = spark.table(table).where(_in_months(months))
        replace_months(held.unionByName(rows.where(_in_months(months))), table, months, tag)
    return months


def compact_months(spark: SparkSession, table: str, months: list[Month] | None = None) -> None:
    """Write months (all, by default) anew as few sorted files: after other writers appended to them."""
    spark.catalog.refreshTable(table)
    months = list(month_locations(spark, table)) if months is None else months
    replace_months(spark.table(table).where(_in_months(months)), table, months, "compacted")


def update_weights(spark: SparkSession, table: str, purchases: DataFrame, old: DataFrame, new: DataFrame, tag: str | None = None) -> list[Month]:
    """Bring a pre-weighted store (C14) up to date with changed household weights; returns the months that were rewritten.

    ``purchases`` are those that the store was written from, ``old`` and ``new`` the household
    tables. Households whose summed weight or number of copies differs, that came or that
    went, are found by joining the two; only months with purchases of theirs are touched,
    and there only their rows are weighted anew, the others are copied.
    """
    spark.catalog.refreshTable(table)
    was, now = (household_weights(h, total=exact_sum).select("hhkey", F.struct("continuo", "n_copies").alias(n)) for h, n in ((old, "was"), (new, "now")))
    differing = was.join(now, "hhkey", "full").where(~F.col("was").eqNullSafe(F.col("now"))).select("hhkey")
    path = scratch_path(spark, "changed-households")
    differing.write.parquet(path)  # read four times
    changed = spark.read.schema(differing.schema).parquet(path)
    theirs = purchases.drop(MONTH).join(changed, "hhkey", "left_semi")
    month = F.trunc("datep", "month") if dict(purchases.dtypes)["datep"] == "date" else F.trunc(F.to_date("datep", "yyyyMMdd"), "month")
    months = [r[0] for r in theirs.select(month.alias(MONTH)).distinct().collect()]
    if not months:
        return []
    weighted = weighted_purchases(theirs, new, exact=True).withColumn(MONTH, F.trunc("datep", "month"))
    kept = spark.table(table).where(_in_months(months)).join(changed, "hhkey", "left_anti")
    replace_months(kept.unionByName(weighted), table, months, tag or f"weights-{uuid.uuid4().hex}")
    return months


def drop_old_months(spark: SparkSession, table: str) -> int:
    """Delete folders of earlier changes that no month points to any more, and return their number.

    Call it when no query that was planned before the last change is still running.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    in_use = {place.rstrip("/") for place in month_locations(spark, table).values()}
    changes = jvm.org.apache.hadoop.fs.Path(f"{_root(spark, table)}/changes")
    fs = changes.getFileSystem(conf)
    if not fs.exists(changes):
        return 0
    dropped = 0
    for change in fs.listStatus(changes):
        for month in fs.listStatus(change.getPath()):
            if month.isDirectory() and month.getPath().toString().rstrip("/") not in in_use:
                fs.delete(month.getPath(), True)
                dropped += 1
        if not any(m.isDirectory() for m in fs.listStatus(change.getPath())):
            fs.delete(change.getPath(), True)
    return dropped
