"""Continuous ingestion and question answering with Structured Streaming.

Chunking and embedding work on one row, so the stream needs no state. Each
micro-batch replaces its own ``batch_id`` partition; a batch that runs twice
leaves the same rows. Beside the rows there are tables of rejected chunks and of the
documents' status.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from ..config import ChunkConfig, CollectionConfig
from ..operators.batchmap import native_documents
from ..operators.chunking import explode_chunks
from ..operators.units import line_units
from ..plans.ingest import chunk_documents, chunk_rows, collection_rows
from ..session import materialise
from .compaction import live_rows, log_of, parts

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def _write_batch(rows: DataFrame, batch_id: int, stream_id: str, path: str) -> None:
    (
        rows.withColumn("stream_id", F.lit(stream_id))
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.partitionBy("stream_id", "batch_id")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def text_chunks(documents: DataFrame, key: str = "doc_id", text: str = "text", chunk: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Text documents to chunk rows; works on a batch and on a stream."""
    parsed = native_documents(line_units(documents, text), key, key)
    return chunk_rows(chunk_documents(parsed, chunk, collapsed=True), chunk.index_mode)


def ingest_stream(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: str | StructType = DOCUMENTS,
    key: str = "doc_id", text: str = "text", file_format: str = "json", files_per_batch: int = 1000,
    collection: CollectionConfig = CollectionConfig(), chunk: ChunkConfig = ChunkConfig(), embedder=None,
    stream_id: str = "ingest", options: dict | None = None,
    blocks: int = 0,
):
    """Start a query that takes all new files of ``source`` into ``target`` and stops.

    ``blocks`` spreads each micro-batch over that many tasks, for files too few or
    too large to fill the cluster by themselves.

    Start it again, with the same checkpoint, to take what has arrived since. Give
    a stream with a new checkpoint a ``stream_id`` of its own.
    """
    documents = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .options(**(options or {}))
        .format(file_format)
        .load(source)
        .withColumn("__version", F.col("_metadata.file_modification_time"))
    )
    if blocks:
        documents = documents.repartition(blocks)

    def take(batch: DataFrame, batch_id: int) -> None:
        parsed = native_documents(line_units(latest_versions(batch, key), text), key, key, ["__version"])
        chunked = materialise(
            chunk_documents(parsed, chunk, collapsed=True).withColumnRenamed("__version", "version"), "batch"
        )
        # the version goes along with the chunks, so nothing is joined back to them
        rows = explode_chunks(chunked, ["source_key", "source_file", "version"], "chunks", chunk.index_mode)
        rows, rejected = collection_rows(rows, collection, embedder)
        _write_batch(rows, batch_id, stream_id, target)
        _write_batch(rejected, batch_id, stream_id, rejects_of(target))
        log = chunked.select("source_key", "source_file", "status", "chunk_count", "error", "version")
        _write_batch(log, batch_id, stream_id, log_of(target))

    return (
        documents.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def rejects_of(target: str) -> str:
    return f"{target.rstrip('/')}__rejected"


def latest_versions(batch: DataFrame, key: str, version: str = "__version") -> DataFrame:
    """One row per document: of the latest file, and of equal times that with the largest content hash.

    Only documents that the batch holds more than once are brought together; the others, usually nearly all,
    are not shuffled.
    """
    others = [c for c in batch.columns if c != key]
    again = batch.groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1").select(F.col(key).alias("__key"))
    same = F.col(key).eqNullSafe(F.col("__key"))
    several = batch.join(again, same, "left_semi")
    newest = F.max(F.struct(version, F.xxhash64(*others).alias("__hash"), *[c for c in others if c != version]))
    chosen = several.groupBy(key).agg(newest.alias("__r")).select(key, *[F.col(f"__r.{c}").alias(c) for c in others])
    return batch.join(again, same, "left_anti").unionByName(chosen)


def current_rows(spark: SparkSession, target: str) -> DataFrame:
    """The streamed collection; of a document that came more than once, its latest version.

    Versions are ordered by the time of their file, then by stream and batch. The log has an
    entry for each, also for one without chunks, which so replaces what came before. After a
    compaction, the snapshot's rows and those of later batches.
    """
    return live_rows(parts(spark, target))


def question_stream(
    spark: SparkSession, source: str, target: str, checkpoint: str, answer_batch,
    schema: str = "qid long, question string", stream_id: str = "questions",
):
    """Answer question files as they arrive. ``answer_batch`` maps a DataFrame of
    questions to one of answers."""
    from ..plans.ask import clean_questions

    questions = clean_questions(spark.readStream.schema(schema).json(source))

    def take(batch: DataFrame, batch_id: int) -> None:
        _write_batch(answer_batch(batch), batch_id, stream_id, target)

    return (
        questions.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class ProgressLog(StreamingQueryListener):
    """Keeps (batch id, input rows, rows per second) of the last finished batches."""

    def __init__(self, keep: int = 1000):
        self.seen: deque[tuple[int, int, float]] = deque(maxlen=keep)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.seen.append((p.batchId, p.numInputRows, p.processedRowsPerSecond))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
