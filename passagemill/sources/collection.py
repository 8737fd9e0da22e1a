"""A vector collection is a catalog table with a fixed schema.

``id`` is derived from the chunk's key, so it does not change between runs or
with the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CollectionConfig
from ..functions.vectors import has_dim

_MOST_WRITERS = 50_000
#: Memory of the rows of a file, and so of the task that writes it.
_FILE_BYTES = 128 * 1024 * 1024
#: Bytes of a row group. Readers and writers hold one of each task in memory that no limit of Spark's counts.
_ROW_GROUP_BYTES = 32 * 1024 * 1024
#: Rows that a loaded collection holds as one object. Java's serializer keeps the last hundred that it wrote, so when blocks go to
#: disk, objects of Spark's default (10 000 rows, about 4 MB) add hundreds of MB a task that no limit counts.
_LOADED_ROWS = 100
_LOADED_ROWS_SETTING = "spark.sql.inMemoryColumnarStorage.batchSize"
COLUMNS = ("id", "source_file", "chunk_index", "text", "embedding")


def chunk_id(chunks: DataFrame) -> Column:
    """Id of a chunk from the full key of its source, or its name if that is all."""
    source = "source_key" if "source_key" in chunks.columns else "source_file"
    return F.xxhash64(F.col(source).cast("string"), F.col("chunk_index").cast("long"))


def to_collection(chunks: DataFrame) -> DataFrame:
    """Bring embedded chunks into the collection schema; extra columns, the full key of
    the source among them, stay behind it."""
    extra = [c for c in chunks.columns if c not in COLUMNS]
    return chunks.select(
        chunk_id(chunks).alias("id"),
        "source_file",
        F.col("chunk_index").cast("long"),
        "text",
        F.col("embedding").cast("array<float>"),
        *extra,
    )


def text_problem(config: CollectionConfig) -> Column:
    """Why a chunk cannot be stored, or null. Lengths are in bytes."""
    return (
        F.when(F.octet_length("source_file") > config.max_source_bytes, "source_file too long")
        .when(F.octet_length("text") > config.max_text_bytes, "text too long")
    )


def dim_problem(dim: int, vector: str = "embedding") -> Column:
    return F.when(~has_dim(F.col(vector), dim), F.concat(F.lit("dimension is not "), F.lit(str(dim))))


def require_dim(df: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """Fail the job on a vector of another dimension, as a typed store would."""
    checked = F.when(has_dim(F.col(vector), dim), F.col(vector)).otherwise(
        F.raise_error(F.concat(F.lit(f"expected dimension {dim}, got "), F.size(vector).cast("string")))
    )
    return df.withColumn(vector, checked)


def full_name(config: CollectionConfig) -> str:
    return f"`{config.database}`.`{config.name}`"


def exists(spark: SparkSession, config: CollectionConfig) -> bool:
    return spark.catalog.databaseExists(config.database) and spark.catalog.tableExists(
        f"{config.database}.{config.name}"
    )


def collections(spark: SparkSession, database: str = "default") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def find_database(spark: SparkSession, name: str) -> str | None:
    """The first database, by name, that holds a collection called ``name``."""
    for db in sorted(d.name for d in spark.catalog.listDatabases()):
        if spark.catalog.tableExists(f"{db}.{name}"):
            return db
    return None


def _row_bytes(df: DataFrame) -> Column:
    """About the memory of a row: texts by their bytes, lists by their length."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        kind = f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(kind, T.ArrayType):
            each = {T.FloatType: 4, T.IntegerType: 4}.get(type(kind.elementType), 8)
            width = width + each * F.greatest(F.coalesce(F.size(f.name), F.lit(0)), F.lit(0))
    return width


def even_files(df: DataFrame, column: str, rows_per_file: int, bytes_per_file: int = _FILE_BYTES) -> DataFrame:
    """Lay rows out for a table partitioned by ``column``.

    Each value gets as many files as its rows and their bytes ask for, each file from a task of its own, so
    a value that holds a third of all rows is written by many tasks, a rare one
    does not leave a file per task, and no task holds more than about ``bytes_per_file``. ``df`` is read twice: pass a stored table.
    """
    by_rows, by_bytes = (F.ceil(x / F.lit(y)) for x, y in ((F.count("*"), rows_per_file), (F.sum(_row_bytes(df)), bytes_per_file)))
    # One row per partition folder, so it is small.
    parts = df.groupBy(column).agg(F.greatest(by_rows, by_bytes, F.lit(1)).cast("long").alias("__parts")).collect()
    table, files = [], 0
    for value, n in parts:
        table.append((value, n, files))
        files += n
    kind = T.StructType([T.StructField("__value", df.schema[column].dataType), T.StructField("__parts", T.LongType()), T.StructField("__first", T.LongType())])
    firsts = F.broadcast(df.sparkSession.createDataFrame(table, kind))
    # Null-safe: rows without a value stay.
    spread_out = df.alias("d").join(firsts, F.col(f"d.{column}").eqNullSafe(F.col("__value")), "left")
    writers = max(1, min(files, _MOST_WRITERS))
    file = F.col("__first") + F.pmod(F.xxhash64("id"), F.col("__parts"))
    return spread_out.repartitionById(writers, F.pmod(file, F.lit(writers)).cast("int")).drop("__parts", "__first", "__value")


def _writer(df: DataFrame) -> DataFrameWriter:
    return df.write.format("parquet").option("parquet.block.size", _ROW_GROUP_BYTES)


def create_or_replace(
    df: DataFrame, config: CollectionConfig, partition_by: str | None = None, rows_per_file: int = 1_000_000
) -> None:
    """Destructive: an existing collection of this name is dropped.

    All rows are computed and written aside first, in the final layout, so a failure in
    parsing, embedding or layout leaves the old collection untouched. Only then is
    the old table dropped; a plain table is renamed, a partitioned one copied.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{config.database}`")
    side, laid = (f"`{config.database}`.`{config.name}__{x}`" for x in ("new", "laid"))
    for name in (side, laid):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    _writer(df).saveAsTable(side)
    if partition_by is None:
        spark.sql(f"DROP TABLE IF EXISTS {full_name(config)}")
        spark.sql(f"ALTER TABLE {side} RENAME TO {full_name(config)}")
        return
    table = even_files(spark.table(side), partition_by, rows_per_file)
    _writer(table).partitionBy(partition_by).saveAsTable(laid)
    spark.sql(f"DROP TABLE {side}")
    spark.sql(f"DROP TABLE IF EXISTS {full_name(config)}")
    # a rename would leave the catalog's partitions at their old place
    _writer(spark.table(laid)).partitionBy(partition_by).saveAsTable(full_name(config))
    spark.sql(f"DROP TABLE {laid}")


def append(
    df: DataFrame, config: CollectionConfig, partition_by: str | None = None, rows_per_file: int = 1_000_000
) -> None:
    """Add rows. With ``partition_by``, ``df`` must be a stored table."""
    if partition_by is None:
        _writer(df).mode("append").option("maxRecordsPerFile", rows_per_file).saveAsTable(full_name(config))
        return
    _writer(even_files(df, partition_by, rows_per_file)).mode("append").partitionBy(partition_by).saveAsTable(full_name(config))


def open_collection(spark: SparkSession, config: CollectionConfig) -> DataFrame:
    return spark.table(full_name(config))


def count_rows(spark: SparkSession, config: CollectionConfig) -> DataFrame:
    return open_collection(spark, config).agg(F.count("*").alias("row_count"))


def describe(spark: SparkSession, config: CollectionConfig) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {full_name(config)}")


def load(spark: SparkSession, config: CollectionConfig) -> DataFrame:
    """Keep the collection in executor memory (spilling to disk) for repeated searches. It is filled at once, in small objects."""
    rows = spark.conf.get(_LOADED_ROWS_SETTING)
    spark.conf.set(_LOADED_ROWS_SETTING, str(_LOADED_ROWS))
    try:
        loaded = open_collection(spark, config).cache()
        loaded.count()
    finally:
        spark.conf.set(_LOADED_ROWS_SETTING, rows)
    return loaded


def drop(spark: SparkSession, config: CollectionConfig) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {full_name(config)}")


def query(
    df: DataFrame,
    where: str = "",
    fields: list[str] | None = None,
    limit: int | None = None,
    order: tuple[str, ...] = ("source_file", "chunk_index"),
) -> DataFrame:
    """Scalar query: filter string (empty keeps all), fields, first rows in key order.

    ``fields=["count(*)"]`` returns the row count.
    """
    out = df.filter(where) if where.strip() else df
    if fields == ["count(*)"]:
        return out.agg(F.count("*").alias("count(*)"))
    if limit is not None:
        out = out.orderBy(*order).limit(limit)
    return out.select(*fields) if fields else out
