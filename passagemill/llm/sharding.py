"""Sharding by a two-pass external shuffle, with DataFrame functions only.

First pass: each row goes to a bucket by a seeded hash of its id and its place in the
input, so that buckets are equal to chance whatever keys, sources or copies there
are; their number follows from the bytes, so that a bucket fits in memory. Second
pass: a bucket is one array; ``shuffle`` draws a Fisher-Yates permutation of it, and the
rows are written with their positions. The buckets one after another are the shuffled
corpus, which is cut into shards of equal row counts: law ``rows``.

Null texts count one byte. Ties and repeated rows are rows of their own. An
empty table gives no rows. Extra columns pass through; a result column takes the place of one of its name.
The input must be a stored table (its rows are told apart by their place in it). With
the same files, settings and seed the result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

SHARDS = 8
#: Bytes of text in a bucket, on average.
BUCKET_BYTES = 16 << 20
#: At least so many buckets, and at most so many, as a shuffle has no more parts: beyond 16 TB buckets grow, to 95 MB at 100 TB.
LEAST_BUCKETS, MOST_BUCKETS = 96, 1 << 20
SEED = 11


def shuffled(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Written table of ``docs`` with __bucket and __pos, its place in the shuffled bucket."""
    volume = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()[0] or 0
    buckets = int(min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-volume // bucket_bytes))))
    columns = docs.columns
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    place = F.monotonically_increasing_id()
    scattered = docs.select(place.alias("place"), F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), place), F.lit(buckets)).cast("int").alias("bucket"), row.alias("row"))
    # each bucket in a task of its own: hashed once more, several would share one
    grouped = scattered.repartitionById(buckets, F.col("bucket")).groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("place", "row"))).alias("rows"))
    # in the order of buckets, so that the generator of a task meets them in the same order each time
    drawn = grouped.sortWithinPartitions("bucket").select("bucket", F.shuffle("rows", F.lit(seed)).alias("rows"))
    out = drawn.select("bucket", F.posexplode("rows").alias("pos", "r"))
    return materialise(out.select(F.col("bucket").alias("__bucket"), F.col("pos").cast("long").alias("__pos"), *[F.col(f"r.row.c{i}").alias(c) for i, c in enumerate(columns)]), "buckets")


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    text: str = "text",
    doc_id: str = "doc_id",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with shard (counts at most one apart) and slot (0, 1, ... in each shard)."""
    rows = shuffled(docs.select(*[c for c in docs.columns if c.lower() not in ("shard", "slot")]), text, doc_id, seed, bucket_bytes)
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    # one row a bucket, at most MOST_BUCKETS of 24 bytes
    counts = rows.groupBy(F.col("__bucket").alias("__b")).agg(F.count("*").alias("n"))
    starts = counts.select("__b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    n = rows.count()
    joined = rows.join(F.broadcast(starts), F.col("__bucket") == F.col("__b"))
    place = F.col("__start") + F.col("__pos")
    joined = joined.withColumn("shard", F.expr(f"((__start + __pos) * {shards}) div {max(1, n)}").cast("int"))
    first = F.expr(f"(shard * bigint({n}) + {shards - 1}) div {shards}")
    return joined.withColumn("slot", (place - first).cast("long")).drop("__bucket", "__pos", "__b", "__start")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder a shard, rows in the order of their slots."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
