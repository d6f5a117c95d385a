"""Date-partitioned purchase stores, written once and queried many times.

Layout: Parquet partitioned by month (``month`` = first day of the month of
``datep``; or by ``datep`` itself with ``granularity="day"``), rows sorted by
``hhkey, brand, datep`` inside each file: clustered by household and brand, as
the reference clusters its day partitions. So the rows of a household lie
together, a scan task's partial aggregate meets each (household, brand) once,
and row-group statistics on ``hhkey`` skip for household look-ups. A period
filter prunes whole month directories (``classify`` adds the month predicate
implied by the date filter). Month directories keep the directory count small:
a day partition of a small panel holds a few hundred rows, and listing thousands
of such directories costs more than reading them.

Before the write the rows are rebalanced by the partition column (Spark's
REBALANCE hint): rows of one partition meet in one task, so it is written as
few files, and adaptive execution splits a partition that holds a large share
of all rows over several tasks (and merges small ones) from the shuffle
statistics. Unlike a range repartition this needs no sampling pass over the
whole input.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact_sum, parse_yyyymmdd, plain_sum
from ..operators.spend import household_weights


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session without it is an error on a cluster, where a folder of one machine
    would be lost to the others. Only in a local session, as in tests, a
    temporary folder takes its place.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="brandflow-scratch-"))
        root = sc.getCheckpointDir()
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/brandflow/{name}-{uuid.uuid4().hex}"


MONTH = "month"


def with_partition_column(df: DataFrame, granularity: str) -> tuple[DataFrame, str]:
    if granularity == "month":
        return df.withColumn(MONTH, F.trunc("datep", "month")), MONTH
    if granularity == "day":
        return df, "datep"
    raise ValueError(f"granularity must be 'month' or 'day', not {granularity!r}")


#: Parquet settings for look-ups by household: small row groups, whose ranges of the sorted ``hhkey`` rule most of them out.
HOUSEHOLD_INDEX = {"parquet.block.size": str(8 << 20), "parquet.page.size": str(64 << 10), "parquet.page.row.count.limit": "2000"}


def _clustered(df: DataFrame, part: str, num_partitions: int | None = None, by_household: bool = False) -> DataFrame:
    """``df`` as it is written: rows of a partition together, sorted by household, brand and day.

    The partition column comes first in the sort: the writer wants its rows together and else sorts anew.
    ``by_household`` deals large partitions out by ranges of ``hhkey`` (which samples the input), so a
    household is in one file of each; else adaptive execution splits them anyhow.
    """
    if by_household:
        n = num_partitions or shuffle_partitions(df.sparkSession)
        df = df.repartitionByRange(n, part, "hhkey")
    else:
        df = df.hint("rebalance", num_partitions, part) if num_partitions else df.hint("rebalance", part)
    return df.sortWithinPartitions(part, "hhkey", "brand", "datep")


def write_clustered(df: DataFrame, path: str, part: str) -> None:
    """Write rows into a new folder, laid out as in a store."""
    _clustered(df, part).write.partitionBy(part).parquet(path)


def household_history(spark: SparkSession, location: str, hhkeys: list[int]) -> DataFrame:
    """All rows of a few households in a store. Their keys are pushed to the Parquet reader, which skips by the sorted ``hhkey``."""
    return _read_store(spark, location).where(F.col("hhkey").isin(list(hhkeys)))


def _write_partitioned(
    df: DataFrame,
    path: str,
    mode: str,
    num_partitions: int | None,
    table: str | None = None,
    granularity: str = "month",
    household_index: bool = False,
) -> None:
    df, part = with_partition_column(df, granularity)
    writer = _clustered(df, part, num_partitions, household_index).write.mode(mode).partitionBy(part)
    if household_index:
        writer = writer.options(**HOUSEHOLD_INDEX)
    if table:
        # External table in the session catalog: its partitions are registered,
        # so a period filter prunes days in the catalog before any listing.
        writer.option("path", path).saveAsTable(table)
    else:
        writer.parquet(path)


def _is_path(location: str) -> bool:
    return os.sep in location or "://" in location


def _read_store(spark: SparkSession, location: str, schema=None) -> DataFrame:
    if not _is_path(location):
        return spark.table(location)
    reader = spark.read.option("basePath", location)
    return (reader.schema(schema) if schema is not None else reader).parquet(location)


def _typed_dates(purchases: DataFrame) -> DataFrame:
    if dict(purchases.dtypes).get("datep") == "string":
        return purchases.withColumn("datep", parse_yyyymmdd("datep"))
    return purchases


def write_purchase_store(
    purchases: DataFrame,
    path: str,
    *,
    table: str | None = None,
    mode: str = "errorifexists",
    num_partitions: int | None = None,
    granularity: str = "month",
    household_index: bool = False,
) -> str:
    """Every purchase column, ``datep`` parsed to DATE (a malformed date raises).

    ``household_index`` lays the files out for look-ups by household (``household_history``).

    Returns ``table`` when given (the store is then also registered in the
    session catalog), else ``path``; either can be passed to the reader.
    """
    _write_partitioned(_typed_dates(purchases), path, mode, num_partitions, table, granularity, household_index)
    return table or path


def read_purchase_store(spark: SparkSession, location: str) -> DataFrame:
    """Open a purchase store by catalog table name or by path."""
    return _read_store(spark, location)


def weighted_purchases(purchases: DataFrame, households: DataFrame | None, *, exact: bool = False, brand: str = "brand") -> DataFrame:
    """One row per purchase with the weights applied: ``hhkey, brand, datep, spent_cs, spent_fs``.

    ``spent_cs = value * brandfactor * continuo``,
    ``spent_fs = value * brandfactor * rwkorr * rwstd * fullmasW``.
    Household copies are folded first (summed weight, full-sample value
    counted once per copy), which gives the same per-(household, brand) sums
    as one row per purchase and copy, without multiplying the purchase rows.
    Purchases of households absent from the table are dropped. ``exact`` sums the
    weights of a household's copies without dependence on their order. Without
    ``households`` the purchases carry their folded weights (``n_copies, continuo``).
    ``brand`` is the column that tells the brand.
    """
    base = F.col("value") * F.col("brandfactor")
    full = base * F.col("rwkorr") * F.col("rwstd") * F.col("fullmasW")
    own = [] if households is not None else ["n_copies", "continuo"]
    # multiplied before the join, which then carries two values and not five
    rows = _typed_dates(purchases).select("hhkey", brand, "datep", base.alias("spent_cs"), full.alias("spent_fs"), *own)
    if households is not None:
        # the household's weight counts, not the purchase's copy of it
        rows = rows.join(household_weights(households, total=exact_sum if exact else plain_sum), "hhkey")
    return rows.select(
        "hhkey",
        brand,
        "datep",
        (F.col("spent_cs") * F.col("continuo")).alias("spent_cs"),
        (F.col("spent_fs") * F.col("n_copies")).alias("spent_fs"),
    )


def write_weighted_store(
    purchases: DataFrame,
    households: DataFrame | None,
    path: str,
    *,
    table: str | None = None,
    mode: str = "errorifexists",
    num_partitions: int | None = None,
    granularity: str = "month",
    household_index: bool = False,
) -> str:
    """C14: the pre-weighted store (returns ``table`` or ``path``, and takes ``household_index``, as C13).

    Purchases that are weighted already (with ``spent_cs``) are written as they are; ``households`` may be None then.
    """
    rows = purchases if "spent_cs" in purchases.columns else weighted_purchases(purchases, households)
    _write_partitioned(rows, path, mode, num_partitions, table, granularity, household_index)
    return table or path


def read_weighted_store(spark: SparkSession, location: str) -> DataFrame:
    """Open a pre-weighted store by catalog table name or by path."""
    return _read_store(spark, location)


def shuffle_partitions(spark: SparkSession) -> int:
    """The partition count of the session's shuffles (AQE's initial count when set)."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


#: Buckets of a C3 table at most; Spark's own limit is 100 000, and C3 is far smaller than the purchases.
MAX_TABLE_BUCKETS = 8192

#: C3 tables that this application wrote, with their folders.
_OWN_TABLES: dict[str, list[tuple[str, str]]] = {}


def materialize_by_household(df: DataFrame, name: str, *, partitioned: bool = False) -> DataFrame:
    """Write ``df`` as a table bucketed by ``hhkey`` in the checkpoint folder; read it back.

    This cuts the lineage like ``checkpoint()``, and the bucketed scan reports
    ``hashpartitioning(hhkey)``, so windows and joins on the household read it
    without another shuffle. The bucket count is the session's shuffle partition
    count, up to ``MAX_TABLE_BUCKETS``. When both counts agree and ``df`` comes
    out of a shuffle on ``hhkey`` (``partitioned=True``), every task holds whole
    buckets and the write adds neither a shuffle nor more than one file per
    bucket and task. Otherwise the rows are shuffled by ``hhkey`` first, so a task
    does not write a file for every bucket.
    """
    spark = df.sparkSession
    n = min(shuffle_partitions(spark), MAX_TABLE_BUCKETS)
    table = f"brandflow_{name}_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, name)
    if not partitioned or n != shuffle_partitions(spark):
        df = df.repartition(n, "hhkey")
    _OWN_TABLES.setdefault(spark.sparkContext.applicationId, []).append((table, path))
    df.write.bucketBy(n, "hhkey").option("path", path).saveAsTable(table)
    return spark.table(table)


def drop_scratch_tables(spark: SparkSession) -> int:
    """Drop the C3 tables that this application wrote, and their files. Tables of others stay.

    Results that read them can't be computed any more: call it after they were used.
    """
    own = _OWN_TABLES.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for table, path in own:
        spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return len(own)
