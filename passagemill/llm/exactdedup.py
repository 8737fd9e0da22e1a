"""Exact deduplication by progressive refinement, with DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. Rows are told apart by ever dearer
keys, and only rows that still share a key go on to the next: the length in bytes, a
hash of the first bytes, the SHA-256 of the whole. A first scan writes length and
prefix hash, a few bytes a row; lengths that occur once, then (length, prefix) pairs that
occur once, are left behind. The second scan reads the whole text of what remains and
of nothing else. Its rows are told by a bitmap of fixed size over the surviving pairs:
one set by chance costs a hash, and the full hash decides.

Null counts as empty, and empty texts are equal. Of equal texts the row with the largest id
stays, any id before none; of rows that repeat text and id one stays. An empty table
stays empty. Extra columns pass through; a result column takes the place of one of its name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, materialise

#: Characters of the text that the second key looks at.
PREFIX_CHARS = 64
#: Bitmaps of 32 768 bits (4 KB) each that tell surviving pairs; what is broadcast has at most so many.
BITMAPS = 2048
#: A group of more than this part of all rows is hot: there are fewer than HOT_PARTS of them.
HOT_PARTS = 1000

RESULTS = ("keep_id", "group_size", "kept")
_MAP_BITS = 32_768


def normal(text: str | Column) -> Column:
    """What is compared: the text with A-Z lower-cased, null as empty."""
    return ascii_lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def _bit(*keys: Column) -> tuple[Column, Column]:
    """(number of the bitmap, bit in it) of a key."""
    place = F.pmod(F.xxhash64(*keys), F.lit(BITMAPS * _MAP_BITS))
    return F.floor(place / _MAP_BITS).cast("int"), F.pmod(place, F.lit(_MAP_BITS))


def bitmaps(keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(__map, __bits) of all keys: at most BITMAPS rows of 4 KB, whatever the number of keys."""
    number, bit = _bit(*[F.col(c) for c in columns])
    return keys.select(number.alias("__map"), bit.alias("__bit")).groupBy("__map").agg(F.bitmap_construct_agg("__bit").alias("__bits"))


def marked(df: DataFrame, found: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """``df`` with a flag: whether the bitmaps may hold the row's key. True for every key they were made of."""
    number, bit = _bit(*[F.col(c) for c in columns])
    rows = df.withColumn("__at", number).withColumn("__bit", bit)
    rows = rows.join(F.broadcast(found), F.col("__at") == F.col("__map"), "left")
    byte = F.conv(F.hex(F.substr("__bits", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    on = F.floor(byte / F.pow(F.lit(2), F.pmod("__bit", F.lit(8)))).cast("int").bitwiseAND(F.lit(1)) == 1
    return rows.withColumn(out, F.coalesce(on, F.lit(False))).drop("__at", "__bit", "__map", "__bits")


def _cheap_keys(text: str) -> tuple[Column, Column]:
    """Length in bytes and a hash of the first characters, without touching the rest of the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.octet_length(whole).cast("long"), F.xxhash64(ascii_lower(F.substring(whole, 1, PREFIX_CHARS)))


def surviving_pairs(docs: DataFrame, text: str) -> DataFrame:
    """(__length, __prefix) pairs that more than one row has."""
    length, prefix = _cheap_keys(text)
    marks = materialise(docs.select(length.alias("__length"), prefix.alias("__prefix")), "lengths")
    lengths = marks.groupBy("__length").count().where("count > 1")
    rows = marked(marks, materialise(bitmaps(lengths, ["__length"]), "length-bits"), ["__length"], "__on").where("__on")
    return rows.groupBy("__length", "__prefix").count().where("count > 1").drop("count")


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with keep_id, group_size and kept.

    Texts are never shuffled: groups are counted over (length, prefix, digest), combined
    in each task first. Rows of groups that hold more than a HOT_PARTS-th of all rows meet
    them by broadcast, others by their digest, and rows that no other equals stay where
    they are.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c.lower() not in RESULTS]
    pairs = materialise(bitmaps(surviving_pairs(docs, text), ["__length", "__prefix"]), "pair-bits")
    length, prefix = _cheap_keys(text)
    rows = marked(docs.withColumn("__length", length).withColumn("__prefix", prefix), pairs, ["__length", "__prefix"], "__on")
    digest = F.when(F.col("__on"), F.sha2(normal(text).cast("binary"), 256))
    row, own = free_name(docs, "__row"), free_name(docs, "__id")
    # ids and digests are written in one scan, so a row's number always means the same row
    rows = rows.select(
        *columns, F.col(doc_id).alias(own), digest.alias("__digest"), "__length", "__prefix", F.monotonically_increasing_id().alias(row)
    )
    rows = materialise(rows, "digests")

    alike = ["__length", "__prefix", "__digest"]
    groups = rows.where("__digest is not null").groupBy(*alike)
    groups = groups.agg(F.count("*").alias("__size"), F.max(F.struct(own, row)).alias("__best")).where("__size > 1")
    groups = materialise(groups, "groups")
    hot = F.col("__size") * HOT_PARTS > rows.count()
    by = [F.col(k) == F.col(f"__g{k}") for k in alike]
    right = groups.withColumnsRenamed({k: f"__g{k}" for k in alike})
    by_hot = F.col("__digest").isNotNull() & by[0] & by[1] & by[2]
    told = rows.join(F.broadcast(right.where(hot)), by_hot, "left")
    # rows without a digest, or in a hot group, are done; only the others are shuffled, a few bytes and ``columns`` each
    done = told.where(F.col("__digest").isNull() | F.col("__size").isNotNull())
    others = told.where("__digest is not null and __size is null").select(*rows.columns).join(right.where(~hot), by, "left")
    alone = F.col("__size").isNull()
    return done.unionByName(others).select(
        *columns,
        F.when(alone, F.col(own)).otherwise(F.col("__best")[own]).alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("__best")[row] == F.col(row))).alias("kept"),
    )


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that equal another one which stays."""
    names = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in RESULTS}
    found = exact_duplicates(docs.withColumnsRenamed(names), names.get(text, text), names.get(doc_id, doc_id))
    return found.where("kept").select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])
