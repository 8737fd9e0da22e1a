"""Session helper and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "passagemill", memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_local_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    The folder must be shared by all executors. Only a local-mode session may
    run without it, in which case one temporary folder serves the whole session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not (context.master == "local" or context.master.startswith("local[")):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        app = context.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="passagemill-")
        root = _local_scratch[app]
    return f"{root.rstrip('/')}/passagemill/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where an expensive stage feeds more than one output; the written table
    survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists_path(spark: SparkSession, path: str) -> bool:
    where, system = _at(spark, path)
    return system.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    where, system = _at(spark, path)
    return system.exists(where) and system.getFileStatus(where).isDirectory()


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    where, system = _at(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(where)) if system.exists(where) else []


def mark_done(spark: SparkSession, path: str) -> None:
    """An empty file."""
    where, system = _at(spark, path)
    system.create(where, True).close()


def delete_path(spark: SparkSession, path: str) -> None:
    where, system = _at(spark, path)
    system.delete(where, True)


def spread(df: DataFrame, blocks: int | None = None) -> DataFrame:
    """Repartition a scan that has fewer splits than the cluster has cores.

    Tables of real size have more splits than cores and pass through without a
    shuffle. Call it on a scan, before any exchange.
    """
    want = blocks or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
