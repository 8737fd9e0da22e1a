"""Mixing of sources to target weights, with DataFrame functions only.

Sizes are words. A source's target is its weight's share of the whole, at most
``most`` times its size; what is cut off is shared by weight among the others until
none is above. With rate = target / size, each document is taken floor(rate) times,
and once more if a number in [0, 1) hashed from seed and id lies below the fraction.

Null texts have size 0. Null source is a source, after all others. Rows with the same id share
the hashed number (rows without id are told apart by their text). Sources without any word have target 0 and their
documents are taken floor(0) = 0 times. An empty table stays empty. Extra columns pass through; a result column takes
the place of one of its name. Reruns agree, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import join_groups, materialise, running_start, word_count

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MOST = 2.0
SEED = 7


def uniform(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from 52 bits of an MD5."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("text|"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def targets(sizes: DataFrame, source: str, weights: Sequence[float] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row a source.

    Sources are numbered in order by ranges, not in one task. The water level is
    found in rounds, each one aggregation: those that reach their bound are taken out
    and the rest is shared by weight, until none is above.
    """
    by = F.col(source).asc_nulls_last()
    local = Window.partitionBy("part").orderBy(by)
    ranged = sizes.repartitionByRange(by).withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged.withColumn("one", F.lit(1)).withColumn("local", F.row_number().over(local)), "sources")
    ranked = running_start(ranged, "part", ["local"], "one", "rank").drop("one", "local", "part")
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    table = materialise(ranked.withColumn("weight", cycle).drop("rank"), "weights")
    bound = F.col("source_size") * float(most)
    everything = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while everything:
        over = bound <= F.col("weight") * level
        taken, free = table.agg(F.sum(F.when(over, bound).otherwise(0.0)), F.sum(F.when(~over, F.col("weight")).otherwise(0.0))).first()
        if not free:
            break
        now = (total * everything - taken) / free
        if now <= level:
            break
        level = now
    return table.withColumn("target", F.least(bound, F.col("weight") * level))


def mix(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    total: float = TOTAL,
    most: float = MOST,
    seed: int = SEED,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with size, source_size, target, copies and taken."""
    results = ("size", "source_size", "target", "copies", "taken")
    columns = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results]
    sizes = docs.groupBy(source).agg(F.sum(word_count(F.col(text))).alias("source_size"))
    found = materialise(targets(sizes, source, weights, total, most), "targets")
    inner = list(dict.fromkeys([*columns, source]))
    rows = docs.select(*inner, word_count(F.col(text)).alias("size"), uniform(F.col(doc_id), F.col(text), seed).alias("__u"))
    rows = join_groups(rows, found.select(source, "source_size", "target"), [source], found.count(), F.xxhash64("__u"))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    copies = (F.floor(rate) + (F.col("__u") < rate - F.floor(rate)).cast("long")).cast("long")
    return rows.withColumn("copies", copies).select(
        *columns, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """Each row of mix() as often as it is taken."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("__copy")
