"""Append newly arrived purchase files to a store with Structured Streaming.

The file sink keeps a commit log next to the data (``_spark_metadata``), so
each input file is written exactly once even when the query restarts after a
failure; readers of the store only see committed files. The query's own
progress lives in ``checkpoint_location``, by default the folder next to the
store named like it with ``.checkpoint`` added: a second call for the same store
goes on where the first stopped. The two belong together, since the sink knows
its batches by the numbers that the progress folder gives them. Each trigger
adds files of its own, unsorted. ``start_clustered_stream`` keeps a catalog store
sorted instead: each batch is merged into its months.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.months import merge_rows
from ..sources.schemas import RAW_PURCHASES
from ..sources.stores import _typed_dates, weighted_purchases, with_partition_column


def start_store_stream(
    spark: SparkSession,
    source_dir: str,
    store_path: str,
    *,
    households: DataFrame | None = None,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    granularity: str = "month",
) -> StreamingQuery:
    """Stream raw purchase Parquet files from ``source_dir`` into a store.

    With ``households`` the rows are pre-weighted (C14; stream-static join on
    the folded household table), otherwise they are stored as they are with a
    DATE ``datep`` (C13). ``available_now`` processes what is there and stops.
    """
    reader = spark.readStream.schema(RAW_PURCHASES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = _typed_dates(reader.parquet(source_dir))
    if households is not None:
        rows = weighted_purchases(rows, households)
    rows, part = with_partition_column(rows, granularity)
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy(part)
        .option("checkpointLocation", checkpoint_location or f"{store_path.rstrip('/')}.checkpoint")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(store_path)


def _stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """An id that lives and goes with the checkpoint folder, so batch numbers that start anew are not taken for old ones."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_location}/stream-id")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, False)
        out.writeBytes(uuid.uuid4().hex)
        out.close()
    source = fs.open(path)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def start_clustered_stream(
    spark: SparkSession,
    source_dir: str,
    table: str,
    checkpoint_location: str,
    *,
    households: DataFrame | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Stream raw purchase files into a store that is a catalog table partitioned by month, and keep it sorted.

    Each batch is merged with its months, which are written anew and switched in the
    catalog, one after the other; other months keep their files. A batch that was
    interrupted is run again by Spark and skips the months that have it already, so no
    row is lost or doubled. The cost of a batch is the size of the months it touches:
    let drops be large, or use ``start_store_stream`` where sorting can wait.
    ``sources.drop_old_months`` removes what earlier batches left.
    """
    reader = spark.readStream.schema(RAW_PURCHASES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = _stream_id(spark, checkpoint_location)

    def merge(batch: DataFrame, number: int) -> None:
        rows = _typed_dates(batch)
        merge_rows(weighted_purchases(rows, households) if households is not None else rows, table, f"{stream}-{number}")

    writer = reader.parquet(source_dir).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
