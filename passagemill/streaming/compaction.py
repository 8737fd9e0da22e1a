"""Compaction of a streamed collection: superseded rows go, what is current stays as it is.

A snapshot is a numbered folder ``<target>__base/<n>`` with three tables: ``rows``, the live rows;
``log``, the latest entry of every document, also of those that became empty, so that nothing older can bring
them back; and ``marks``, the last batch of each stream that the snapshot holds. An empty file ``_DONE``
is written last: a snapshot without it doesn't exist for readers, so the swap is one step, and a compaction that
fails leaves everything as it was. Readers take the newest snapshot and the batches beyond its marks.
A batch up to its mark that is replayed is not looked at.

Folders that a snapshot replaces are deleted after the swap, unless ``clean`` is off; a reader that
began before and is still running would miss them, so turn it off then, and call ``clean_up`` later.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, exists_path, mark_done, names_below

ENTRY = ["stream_id", "batch_id", "source_file"]


def log_of(target: str) -> str:
    return f"{target.rstrip('/')}__log"


def base_of(target: str) -> str:
    return f"{target.rstrip('/')}__base"


def newest_base(spark: SparkSession, target: str) -> int | None:
    """Number of the newest complete snapshot."""
    base = base_of(target)
    made = [int(n) for n in names_below(spark, base) if n.isdigit()]
    return next((n for n in sorted(made, reverse=True) if exists_path(spark, f"{base}/{n}/_DONE")), None)


@dataclass
class Parts:
    """All rows and log entries that count: those of the snapshot and of the batches after it."""

    rows: DataFrame
    log: DataFrame
    #: (stream_id, batch_id) of the snapshot that they start from, if any.
    marks: DataFrame | None = None


def _batches(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The batch folders of a streamed table; None if there are none."""
    streams = [n for n in names_below(spark, path) if n.startswith("stream_id=")]
    if not any(n.startswith("batch_id=") for s in streams for n in names_below(spark, f"{path.rstrip('/')}/{s}")):
        return None
    reader = spark.read.option("basePath", path)
    # folder names like 7 are read as numbers otherwise, and differ from those of the snapshot
    reader = reader.schema(schema) if schema is not None else reader
    found = reader.parquet(path)
    return found.withColumn("stream_id", F.col("stream_id").cast("string")).withColumn("batch_id", F.col("batch_id").cast("long"))


def parts(spark: SparkSession, target: str) -> Parts:
    number = newest_base(spark, target)
    if number is None:
        found = Parts(_batches(spark, target), _batches(spark, log_of(target)))
        if found.rows is None or found.log is None:
            raise FileNotFoundError(f"no batches below {target}")
        return found
    base = f"{base_of(target)}/{number}"
    rows, log, marks = (spark.read.parquet(f"{base}/{t}") for t in ("rows", "log", "marks"))
    held = F.broadcast(marks.withColumnsRenamed({"stream_id": "__s", "batch_id": "__b"}))  # a row a stream

    def after(path: str, like: DataFrame) -> DataFrame:
        found = _batches(spark, path, like.schema)
        if found is None:
            return like
        old = (F.col("stream_id") == F.col("__s")) & (F.col("batch_id") <= F.col("__b"))
        return like.unionByName(found.join(held, old, "left_anti").select(*like.columns))

    return Parts(after(target, rows), after(log_of(target), log), marks)


def latest_entries(log: DataFrame) -> DataFrame:
    """The log entry that counts for each document: by the time of its file, then by batch and stream."""
    others = [c for c in log.columns if c not in ("source_file", "version", "batch_id", "stream_id")]
    newest = F.max(F.struct("version", "batch_id", "stream_id")).alias("v")
    entry = F.max_by(F.struct(*others), F.struct("version", "batch_id", "stream_id")).alias("r")
    found = log.groupBy("source_file").agg(newest, entry).select("source_file", "v.*", "r.*")
    return found.select(*log.columns)


def live_rows(found: Parts) -> DataFrame:
    return found.rows.join(latest_entries(found.log).select(*ENTRY), ENTRY, "left_semi")


def compact(spark: SparkSession, target: str, clean: bool = True, rows_per_file: int = 1_000_000) -> DataFrame:
    """Write a new snapshot and swap it in: one row with its number, live rows, documents and tombstones.

    One compaction at a time; streams may go on.
    """
    found = parts(spark, target)
    made = [int(n) for n in names_below(spark, base_of(target)) if n.isdigit()]
    number = max(made, default=0) + 1
    base = f"{base_of(target)}/{number}"
    # the marks first, and nothing beyond them after: batches that come meanwhile stay where they are
    batches = found.log.select("stream_id", "batch_id")
    batches = batches if found.marks is None else batches.unionByName(found.marks)
    batches = batches.groupBy("stream_id").agg(F.max("batch_id").alias("batch_id"))
    batches.coalesce(1).write.mode("overwrite").parquet(f"{base}/marks")
    marks = F.broadcast(spark.read.parquet(f"{base}/marks").withColumnsRenamed({"stream_id": "__s", "batch_id": "__b"}))
    held = (F.col("stream_id") == F.col("__s")) & (F.col("batch_id") <= F.col("__b"))
    known = Parts(*[df.join(marks, held, "left_semi") for df in (found.rows, found.log)])
    latest_entries(known.log).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{base}/log")
    log = spark.read.parquet(f"{base}/log")
    rows = known.rows.join(log.select(*ENTRY), ENTRY, "left_semi")
    rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{base}/rows")
    mark_done(spark, f"{base}/_DONE")
    if clean:
        clean_up(spark, target)
    live = spark.read.parquet(f"{base}/rows").agg(F.count("*").alias("live_rows"))
    of_log = log.agg(F.count("*").alias("documents"), F.count_if(F.col("chunk_count") == 0).alias("tombstones"))
    return live.join(F.broadcast(of_log)).select(F.lit(number).cast("long").alias("snapshot"), "*")


def clean_up(spark: SparkSession, target: str) -> None:
    """Delete what the newest snapshot replaces: its batches, older snapshots and unfinished ones."""
    number = newest_base(spark, target)
    if number is None:
        return
    for n in names_below(spark, base_of(target)):
        if n.isdigit() and int(n) < number:
            delete_path(spark, f"{base_of(target)}/{n}")
    marks = {r["stream_id"]: r["batch_id"] for r in spark.read.parquet(f"{base_of(target)}/{number}/marks").collect()}  # a row a stream
    for path in (target, log_of(target)):
        for stream, last in marks.items():
            folder = f"{path.rstrip('/')}/stream_id={stream}"
            for name in names_below(spark, folder):
                if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= last:
                    delete_path(spark, f"{folder}/{name}")
