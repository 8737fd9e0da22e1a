"""What a collection's files and a loaded collection ask of a task's memory."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from passagemill.config import CollectionConfig
from passagemill.sources import collection as store


def vectors(spark, n):
    numbers = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.rand(3).cast("float") + i)
    rows = spark.range(0, n, 1, 1).select("id", F.lit("a").alias("source_file"), F.col("id").alias("chunk_index"), F.lit("x").alias("text"))
    return rows.withColumn("embedding", numbers)


def test_a_loaded_collection_is_held_in_small_objects(spark):
    config = CollectionConfig("loaded_small", dim=64)
    store.create_or_replace(vectors(spark, 1000), config)
    before = spark.conf.get(store._LOADED_ROWS_SETTING)
    loaded = store.load(spark, config)
    held = loaded._jdf.queryExecution().withCachedData().collectLeaves().head().cacheBuilder()
    assert held.isCachedColumnBuffersLoaded() and held.cachedColumnBuffers().count() == 1000 // store._LOADED_ROWS
    assert spark.conf.get(store._LOADED_ROWS_SETTING) == before
    assert loaded.count() == 1000 and loaded.agg(F.sum("id")).head()[0] == 499_500
    loaded.unpersist()
    store.drop(spark, config)


def test_a_file_has_row_groups_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(store, "_ROW_GROUP_BYTES", 100_000)
    config = CollectionConfig("row_groups", dim=64)
    store.create_or_replace(vectors(spark, 4000), config)
    folder = spark.sql(f"DESCRIBE EXTENDED {store.full_name(config)}").where("col_name = 'Location'").head().data_type.removeprefix("file:")
    files = glob.glob(f"{folder}/*.parquet")
    assert len(files) == 1 and pq.ParquetFile(files[0]).metadata.num_row_groups > 2
    assert store.open_collection(spark, config).agg(F.sum("id")).head()[0] == 4000 * 3999 // 2
    store.drop(spark, config)
