"""Run reports: every stage leaves status rows, every report is a query on them.

A run log has ``source_file, status, page_count, chunk_count, error, duration_s,
actor_host`` and, where times matter, ``finished_at``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PROGRESS_EVERY_S, SHOWN_ERROR_CHARS, SHOWN_ERRORS
from ..functions.status import FAILED, known_status, stored_error
from ..functions.text import short_error

# ---- fixed values: monitoring limits ---------------------------------------------
# metric, direction in which it gets worse, warn beyond, alert beyond
THRESHOLDS = (
    ("files_per_second", "below", 0.5, 0.2),
    ("chunks_per_second", "below", 300.0, 100.0),
    ("timeout_rate", "above", 0.01, 0.05),
    ("error_rate", "above", 0.02, 0.10),
    ("avg_duration_s", "above", 6.0, 10.0),
)
# ----------------------------------------------------------------------------------


def _is(status: str) -> Column:
    return known_status(F.col("status")) == status


def normalise_log(log: DataFrame) -> DataFrame:
    """Known status values, stored length of error texts, no counts on failed rows."""
    status = known_status(F.col("status"))
    failed = status.isin(*FAILED)
    return (
        log.withColumn("page_count", F.when(failed, 0).otherwise(F.col("page_count")).cast("long"))
        .withColumn("chunk_count", F.when(status == "success", F.col("chunk_count")).otherwise(0).cast("long"))
        .withColumn("error", stored_error(F.col("error")))
        .withColumn("status", status)
    )


def report_columns() -> list[Column]:
    return [
        F.count("*").alias("total_files"),
        F.count_if(_is("success")).alias("success"),
        F.count_if(_is("empty")).alias("empty"),
        F.count_if(_is("error")).alias("errors"),
        F.count_if(_is("timeout")).alias("timeouts"),
        F.coalesce(F.sum("page_count"), F.lit(0)).cast("long").alias("total_pages"),
        F.coalesce(F.sum("chunk_count"), F.lit(0)).cast("long").alias("total_chunks"),
        F.round(F.avg("duration_s"), 3).alias("avg_duration_s"),
    ]


def run_report(log: DataFrame) -> DataFrame:
    """Counts by status, totals and mean duration: one row, one pass."""
    return log.agg(*report_columns())


def worker_distribution(log: DataFrame, worker: str = "actor_host") -> DataFrame:
    """Files and percent per worker. The total is a scalar from the same grouped rows, so
    the groups, however many, need not meet in one task and the log is grouped once."""
    files = log.groupBy(worker).agg(F.count("*").alias("files"))
    total = files.agg(F.sum("files")).scalar()
    return files.withColumn("pct", F.round(F.col("files") / total * 100, 1)).orderBy(worker)


def first_errors(log: DataFrame, n: int = SHOWN_ERRORS) -> DataFrame:
    """The first failed files by name, with the shown part of the error."""
    return (
        log.filter(known_status(F.col("status")).isin(*FAILED))
        .orderBy("source_file")
        .limit(n)
        .select("source_file", short_error(F.col("error"), SHOWN_ERROR_CHARS).alias("error"))
    )


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def _seconds(moment: Column) -> Column:
    return _micros(moment) / F.lit(1e6)


def throughput(log: DataFrame, finished: str = "finished_at", wall_clock_s: float | None = None) -> DataFrame:
    """Successful files and chunks per second; null for a zero wall clock."""
    wall = (
        F.lit(float(wall_clock_s))
        if wall_clock_s is not None
        else (F.max(_seconds(F.col(finished))) - F.min(_seconds(F.col(finished))))
    )
    return log.agg(
        F.count_if(_is("success")).alias("success"),
        F.coalesce(F.sum("chunk_count"), F.lit(0)).cast("long").alias("chunks"),
        wall.alias("wall"),
    ).select(
        F.round("wall", 3).alias("wall_clock_s"),
        F.round(F.try_divide("success", "wall"), 6).alias("files_per_second"),
        F.round(F.try_divide("chunks", "wall"), 6).alias("chunks_per_second"),
    )


def progress(log: DataFrame, finished: str = "finished_at", every_s: int = PROGRESS_EVERY_S) -> DataFrame:
    """Processed files, percent, rate and remaining minutes at each tick.

    Rows are counted per tick first. Running totals go in two steps, within a block
    of ticks and over the blocks, so no window sees more than a bounded part.
    """
    per_block = 4096
    tick = F.floor(_micros(F.col(finished)) / F.lit(every_s * 1_000_000)).cast("long")
    ticks = log.groupBy(tick.alias("tick")).agg(F.count("*").alias("n"))
    ticks = ticks.withColumn("block", F.floor(F.col("tick") / per_block))
    blocks = ticks.groupBy("block").agg(F.sum("n").alias("block_n"), F.min("tick").alias("block_first"))
    order = Window.orderBy("block")
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("block_n").over(everything).alias("total"),
        F.min("block_first").over(everything).alias("first_tick"),
    )
    inside = Window.partitionBy("block").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    done = F.col("before") + F.sum("n").over(inside)
    rate = F.col("processed") / F.col("elapsed_s")
    return (
        ticks.join(blocks, "block")
        .select(
            "tick",
            "total",
            done.cast("long").alias("processed"),
            ((F.col("tick") - F.col("first_tick") + 1) * every_s).cast("long").alias("elapsed_s"),
        )
        .select(
            "elapsed_s",
            "processed",
            F.round(F.col("processed") * 100 / F.col("total"), 6).alias("pct"),
            F.round(rate, 6).alias("rate"),
            F.round((F.col("total") - F.col("processed")) / rate / 60, 3).alias("eta_min"),
        )
    )


def output_objects(log: DataFrame, key: str = "source_file") -> DataFrame:
    """Number of sources that produced at least one chunk."""
    return log.filter("chunk_count > 0").agg(F.count_distinct(key).alias("objects"))


def reconcile(expected: DataFrame, stored: DataFrame, key: str = "source_file") -> DataFrame:
    """Per source: chunks reported by the run against chunks in the collection.

    ``expected`` has ``key, chunk_count``; ``stored`` has one row per chunk and is
    counted map-side before it is shuffled.
    """
    have = stored.groupBy(key).agg(F.count("*").alias("stored"))
    want = expected.groupBy(key).agg(F.sum("chunk_count").cast("long").alias("expected"))
    return want.join(have, key, "full_outer").select(
        key,
        F.coalesce("expected", F.lit(0)).alias("expected"),
        F.coalesce("stored", F.lit(0)).alias("stored"),
        (F.coalesce("expected", F.lit(0)) == F.coalesce("stored", F.lit(0))).alias("matches"),
    )


def health_metrics(log: DataFrame, finished: str = "finished_at") -> DataFrame:
    """The monitored values as rows ``metric, value``."""
    wall = F.max(_seconds(F.col(finished))) - F.min(_seconds(F.col(finished)))
    n = F.count("*")
    values = log.agg(
        F.try_divide(F.count_if(_is("success")), wall).alias("files_per_second"),
        F.try_divide(F.sum("chunk_count"), wall).alias("chunks_per_second"),
        F.try_divide(F.count_if(_is("timeout")), n).alias("timeout_rate"),
        F.try_divide(F.count_if(_is("error")), n).alias("error_rate"),
        F.avg("duration_s").alias("avg_duration_s"),
    )
    return values.unpivot([], values.columns, "metric", "value")


def health_alerts(log: DataFrame, finished: str = "finished_at", thresholds=THRESHOLDS) -> DataFrame:
    """Each metric with its level: ok, warn or alert."""
    limits = log.sparkSession.createDataFrame(
        list(thresholds), "metric string, direction string, warn_at double, alert_at double"
    )
    value = F.col("value")

    def beyond(limit: str) -> Column:
        return F.when(F.col("direction") == "above", value > F.col(limit)).otherwise(value < F.col(limit))

    level = F.when(beyond("alert_at"), "alert").when(beyond("warn_at"), "warn").otherwise("ok")
    return (
        health_metrics(log, finished)
        .join(F.broadcast(limits), "metric")
        .select("metric", F.round("value", 6).alias("value"), level.alias("level"))
    )


def corpus_size(chunk_lists: DataFrame, chunks: str = "chunks") -> DataFrame:
    """Documents, chunks, bytes and means, from one row per document."""
    n = F.size(chunks).cast("long")
    size = F.aggregate(F.col(chunks), F.lit(0).cast("long"), lambda acc, t: acc + F.octet_length(t))
    return (
        chunk_lists.select(n.alias("n"), size.alias("b"))
        .agg(
            F.count("*").alias("documents"),
            F.sum("n").alias("chunks"),
            F.sum("b").alias("text_bytes"),
        )
        .select(
            "documents",
            "chunks",
            "text_bytes",
            F.round(F.try_divide("chunks", "documents"), 6).alias("chunks_per_document"),
            F.round(F.try_divide("text_bytes", "chunks"), 6).alias("bytes_per_chunk"),
        )
    )


def collection_label(df: DataFrame, name: str) -> DataFrame:
    """``name:rows``, the value an ingest step hands on."""
    return df.agg(F.concat_ws(":", F.lit(name), F.count("*").cast("string")).alias("collection"))
