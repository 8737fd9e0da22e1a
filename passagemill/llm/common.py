"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialise, scratch_path, spread

__all__ = ["materialise", "scratch_path", "spread"]

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 4 << 20
#: ASCII white space between words, as a regular expression class.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/documents.parquet")
    return df.select(*columns) if columns else df


def id_remainder(column: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % divisor


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(c: Column) -> Column:
    """Words between ASCII white space; null and empty texts have none."""
    return F.coalesce(F.regexp_count(c, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def text_slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with at most ``limit`` bytes of text, or one row each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another, and where each row starts (one more at the end)."""
    blobs = texts_of(column)
    starts = np.zeros(len(blobs) + 1, np.int64)
    np.cumsum([len(b) for b in blobs], out=starts[1:])
    return np.frombuffer(b"".join(blobs), np.uint8), starts


class Remembered(dict):
    """What ``make`` gives for each key. Kept in two generations of ``most`` / 2 keys: frequent keys outlive a turn."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most // 2, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found

    def turn(self) -> None:
        """Forget the older generation if the younger one is full; between slices of text."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


def kept(batch: pa.RecordBatch, keep: Sequence[str]) -> list[pa.Array]:
    return [batch.column(c) for c in keep]


def schema_of(df: DataFrame, keep: Sequence[str], *more: tuple[str, str]) -> T.StructType:
    out = T.StructType([df.schema[c] for c in keep])
    for name, kind in more:
        out = out.add(T.StructType.fromDDL(f"{name} {kind}")[0])
    return out


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: A table of at most so many short rows is shipped to every task by join_groups.
SHIPPED_GROUPS = 100_000
SALTS = 32


def join_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], n_groups: int, salt: Column) -> DataFrame:
    """Join each row to its group's row, null keys being equal; every row has a group.

    Up to SHIPPED_GROUPS groups are broadcast. More are joined by shuffle, with the
    rows of a group dealt over SALTS tasks by ``salt``, so that a hot group is cut.
    """
    extra = [c for c in groups.columns if c not in keys]
    right = groups.select(*[F.col(k).alias(f"__g_{k}") for k in keys], *extra)
    same = [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    drop = [f"__g_{k}" for k in keys]
    on = same[0]
    for c in same[1:]:
        on = on & c
    if n_groups <= SHIPPED_GROUPS:
        return df.join(F.broadcast(right), on).drop(*drop)
    right = right.withColumn("__g_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = df.withColumn("__salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    return left.join(right, on & (F.col("__salt") == F.col("__g_salt"))).drop("__salt", "__g_salt", *drop)


def running_start(df: DataFrame, part: str, order: Sequence[str], size: str, out: str) -> DataFrame:
    """``out``: the sum of ``size`` over all rows before, by part and then by ``order``.

    ``df`` must be a written table whose parts are bounded, such as one per task.
    Two steps: within each part, and over the parts' totals (one row a part).
    """
    totals = df.groupBy(part).agg(F.sum(size).alias("__total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col(part).alias("__part"), F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"))
    inner = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumn("__inner", F.coalesce(F.sum(size).over(inner), F.lit(0)))
    joined = inside.join(totals, F.col(part) == F.col("__part"))
    return joined.withColumn(out, (F.col("__base") + F.col("__inner")).cast("long")).drop("__part", "__base", "__inner")
