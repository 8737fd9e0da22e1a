"""Documents to collection, in two steps over chunk files or in one."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ChunkConfig, CollectionConfig, ParseConfig
from ..operators.batchmap import check_error_rate, parse_files
from ..operators.chunking import chunk_count, explode_chunks, greedy_chunks
from ..operators.embedding import embed
from ..operators.ivf import CELL, Centroids, assign_cells
from ..operators.reports import collection_label
from ..functions.status import FAILED
from ..session import materialise
from ..sources import collection as store
from ..sources.jsonl import write_chunk_run

LOG_COLUMNS = ("source_file", "status", "page_count", "chunk_count", "error", "duration_s", "actor_host")


def chunk_documents(
    parsed: DataFrame, config: ChunkConfig = ChunkConfig(), collapsed: bool = False, make_tokenizer=None
) -> DataFrame:
    """Add ``chunks`` and ``chunk_count`` and settle the status of parsed documents."""
    out = greedy_chunks(
        parsed, "units", config.max_tokens, collapsed=collapsed, make_tokenizer=make_tokenizer
    ).withColumn("__n", chunk_count(F.col("chunks")))
    success = F.col("status") == "success"
    all_blank = success & (F.col("__n") == 0)
    return (
        out.withColumn("chunk_count", F.when(success, F.col("__n")).otherwise(0).cast("long"))
        .withColumn("error", F.when(all_blank, "All chunks empty").otherwise(F.col("error")))
        .withColumn("status", F.when(all_blank, "empty").otherwise(F.col("status")))
        .drop("units", "__n")
    )


def chunk_rows(chunked: DataFrame, index_mode: str = "position") -> DataFrame:
    """Chunk rows of parsed documents. Failed and empty ones have no chunks.

    There is no filter on ``status`` on purpose: the optimizer would push it, with
    the whole chunking expression in it, below the chunking and run that twice.
    """
    return explode_chunks(chunked, ["source_key", "source_file"], "chunks", index_mode)


def run_log(chunked: DataFrame) -> DataFrame:
    return chunked.select("source_key", *LOG_COLUMNS)


def parse_step(
    files: DataFrame, make_parser, chunk_path: str, parse: ParseConfig = ParseConfig(),
    chunk: ChunkConfig = ChunkConfig(), make_tokenizer=None, run_id: str | None = None,
) -> DataFrame:
    """First step: parse, chunk and write the chunk files, a folder a run. Returns the run log.

    ``read_chunk_runs`` takes each source's latest run. Writing a ``run_id`` (by
    default the time) again replaces it.

    Parsing is by far the dearest stage, so its result is written once and both
    outputs are read from that table.
    """
    chunked = materialise(
        chunk_documents(parse_files(files, make_parser, parse), chunk, make_tokenizer=make_tokenizer), "chunked"
    )
    log = run_log(chunked)
    check_error_rate(log, parse.max_error_rate)
    write_chunk_run(chunk_rows(chunked, chunk.index_mode), chunk_path, run_id or _run_id())
    return log


def _run_id() -> str:
    """Sorts by time."""
    return time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"-{time.time_ns() % 1_000_000_000:09d}"


def collection_rows(
    chunks: DataFrame, config: CollectionConfig = CollectionConfig(), embedder=None, model: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows in the collection schema, rejected chunks with ``problem``).

    Texts that are too long are set aside before they cost an embedding; a vector
    of the wrong dimension fails the job.
    """
    judged = chunks.withColumn("problem", store.text_problem(config))
    accepted = judged.filter(F.col("problem").isNull()).drop("problem")
    if model is not None:
        accepted = accepted.withColumn("model", F.lit(model))
    rows = store.to_collection(embed(accepted, embedder, dim=config.dim))
    return store.require_dim(rows, config.dim), judged.filter(F.col("problem").isNotNull())


def split_by_dim(rows: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """Quarantine instead of failure: (rows of the right dimension, the others).

    Embeddings are written once and both parts read from there.
    """
    judged = materialise(rows.withColumn("problem", store.dim_problem(dim)), "judged")
    return judged.filter(F.col("problem").isNull()).drop("problem"), judged.filter(F.col("problem").isNotNull())


def load_step(
    chunks: DataFrame, config: CollectionConfig = CollectionConfig(), embedder=None,
    centroids: Centroids | None = None, allow_empty: bool = False,
) -> DataFrame:
    """Second step: embed chunks and replace the collection; over-long chunks go to
    ``<name>__rejected``. Returns ``name:rows`` as one row."""
    spark = chunks.sparkSession
    if not allow_empty and chunks.isEmpty():
        raise FileNotFoundError("no chunks to load")
    rows, rejected = collection_rows(chunks, config, embedder)
    if centroids is not None:
        rows = assign_cells(rows, centroids)
    store.create_or_replace(rows, config, CELL if centroids is not None else None)
    rejects = CollectionConfig(f"{config.name}__rejected", config.database)
    store.create_or_replace(rejected, rejects)
    return collection_label(store.open_collection(spark, config), config.name)


def single_step(
    files: DataFrame, make_parser, config: CollectionConfig = CollectionConfig(), embedder=None,
    parse: ParseConfig = ParseConfig(), chunk: ChunkConfig = ChunkConfig(), make_tokenizer=None,
) -> DataFrame:
    """Files to collection without chunk files between. Returns the run log.

    The collection is the same as after the two steps.
    """
    chunked = materialise(
        chunk_documents(parse_files(files, make_parser, parse), chunk, make_tokenizer=make_tokenizer), "chunked"
    )
    log = run_log(chunked)
    check_error_rate(log, parse.max_error_rate)
    load_step(chunk_rows(chunked, chunk.index_mode), config, embedder, allow_empty=True)
    return with_inserted(log, store.open_collection(files.sparkSession, config))


def with_inserted(log: DataFrame, collection: DataFrame) -> DataFrame:
    """The log with ``chunks_inserted``, what of each source the collection holds."""
    stored = collection.groupBy("source_key").agg(F.count("*").alias("chunks_inserted"))
    return log.join(stored, "source_key", "left").withColumn("chunks_inserted", F.coalesce("chunks_inserted", F.lit(0)))


# ---- incremental runs --------------------------------------------------------------


def not_yet_processed(files: DataFrame, done: DataFrame, on: tuple[str, ...] = ("path", "length", "modified")) -> DataFrame:
    """Files without a run-log entry of the same key; a changed file counts as new."""
    return files.join(done.select(*on), list(on), "left_anti")


def to_retry(files: DataFrame, log: DataFrame, attempts: int = 3, key: str = "source_key") -> DataFrame:
    """Files whose last attempt failed and that have attempts left.

    ``log`` has one row per attempt with a numbered ``attempt``. The latest status is
    taken by an aggregate that combines map-side.
    """
    last = log.groupBy(key).agg(F.max(F.struct("attempt", "status")).alias("last"))
    again = last.filter(F.col("last.status").isin(*FAILED) & (F.col("last.attempt") < attempts)).select(
        key, (F.col("last.attempt") + 1).alias("attempt")
    )
    return files.drop("attempt").join(again, key)


def append_indexed(
    chunks: DataFrame, config: CollectionConfig, centroids: Centroids, embedder=None
) -> None:
    """Add chunks to an indexed collection: existing centroids, no rebuild.

    Chunks whose key (source and number) is already stored are left out, so a repeated call
    adds nothing. Over-long chunks are appended to ``<name>__rejected``, once each.
    """
    spark = chunks.sparkSession
    stored = store.open_collection(spark, config)
    key = [c for c in ("source_key", "source_file") if c in stored.columns and c in chunks.columns][0]
    # The new keys are stored, so the planner knows their size and can send them to
    # the collection instead of shuffling the collection to them.
    on = [key, "chunk_index"]
    new_keys = materialise(chunks.select(F.col(key).cast("string").alias(key), F.col("chunk_index").cast("long")).distinct(), "keys")

    def unseen(table: DataFrame) -> DataFrame:
        known = table.select(*on).join(new_keys, on, "left_semi")
        return chunks.join(known, on, "left_anti")

    rows, _ = collection_rows(unseen(stored), config, embedder)
    indexed = materialise(assign_cells(rows, centroids), "append")
    store.append(indexed.select(*stored.columns), config, CELL)
    rejects = CollectionConfig(f"{config.name}__rejected", config.database)
    if store.exists(spark, rejects):
        _, rejected = collection_rows(unseen(store.open_collection(spark, rejects)), config, embedder)
        store.append(rejected, rejects)
    else:
        _, rejected = collection_rows(chunks, config, embedder)
        store.create_or_replace(rejected, rejects)


def of_model(collection: DataFrame, model: str) -> DataFrame:
    """The part of a collection that one embedding model wrote."""
    return collection.filter(F.col("model") == model)


def inspect(spark: SparkSession, config: CollectionConfig) -> dict:
    """What there is to know about a collection; counts and samples as DataFrames."""
    database = config.database
    if not store.exists(spark, config):
        database = store.find_database(spark, config.name)
        if database is None:
            return {"exists": False, "collections": store.collections(spark, config.database)}
    found = CollectionConfig(config.name, database, config.dim)
    table = store.open_collection(spark, found)
    return {
        "exists": True,
        "database": database,
        "schema": table.schema,
        "row_count": store.count_rows(spark, found),
        "sample": store.query(table, "chunk_index >= 0", ["source_file", "chunk_index", "text"], 5),
    }
