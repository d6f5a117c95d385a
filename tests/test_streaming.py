"""Streaming ingestion: files dropped in a folder end up in the store, once."""

from pyspark.sql import functions as F

from brandflow.plans import gain_loss
from brandflow.sources import read_purchase_store, read_weighted_store, tpch
from brandflow.sources.stores import scratch_path
from brandflow.streaming import start_store_stream

SF = "/root/testdata/sf0.001"


def test_new_files_with_default_settings(spark):
    p = tpch.purchases(spark, SF)
    src, store = scratch_path(spark, "drops"), scratch_path(spark, "default-store")
    for k in range(3):
        p.where(F.pmod(F.col("occaskey"), F.lit(3)) == k).write.parquet(f"{src}/drop={k}")
        start_store_stream(spark, f"{src}/*", store).awaitTermination()
        assert read_purchase_store(spark, store).count() == p.where(F.pmod(F.col("occaskey"), F.lit(3)) <= k).count()
    cols = ["hhkey", "occaskey", "brand", "value"]
    assert read_purchase_store(spark, store).select(cols).exceptAll(p.select(cols)).count() == 0


def test_stream_into_stores_matches_batch(spark):
    p, hh, bm, per = tpch.panel(spark, SF, string_dates=True)
    src = scratch_path(spark, "stream-src")
    # the raw files arrive in three drops
    p = p.withColumn("_drop", F.pmod(F.col("occaskey"), F.lit(3)))
    for k in range(3):
        p.where(F.col("_drop") == k).drop("_drop").write.parquet(f"{src}/drop={k}")
    p = p.drop("_drop")
    store, wstore = scratch_path(spark, "stream-store"), scratch_path(spark, "stream-wstore")
    ckpt = scratch_path(spark, "stream-ckpt")
    start_store_stream(spark, f"{src}/*", store, checkpoint_location=ckpt, max_files_per_trigger=2).awaitTermination()
    start_store_stream(spark, f"{src}/*", wstore, households=hh).awaitTermination()
    # a restart from the same checkpoint finds nothing new: no row is written twice
    start_store_stream(spark, f"{src}/*", store, checkpoint_location=ckpt).awaitTermination()
    back = read_purchase_store(spark, store)
    assert back.count() == p.count()
    streamed = gain_loss(back, hh, bm, per, variant="v6").collect()
    batch = gain_loss(p, hh, bm, per, variant="v6").collect()
    assert streamed == batch
    weighted = gain_loss(read_weighted_store(spark, wstore), None, bm, per, variant="v7").collect()
    assert weighted == batch
