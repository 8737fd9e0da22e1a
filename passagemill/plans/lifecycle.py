"""Registered queries that run whole pipelines and the life of a collection.

Documents are first written as files, dealt over a few folders, so that scan, content, guarded
parsing, chunk files, loading and read-back all take part.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CollectionConfig, ParseConfig, SearchConfig
from ..operators.batchmap import native_documents, parse_files
from ..operators.embedding import EndpointEmbedder, LocalEmbedder, PipelinedEndpoint, embed, embed_or_error, hashed_vectors
from ..operators.generation import generated_by_model
from ..operators.ivf import CELL, Centroids, probed_top_k, recall, train_centroids
from ..operators.packing import pack, with_cost
from ..operators.progress import duration_sketches, merged_quantiles, observed, observed_report
from ..operators.search import top_k, top_k_by_model
from ..operators.units import line_units
from ..session import materialise, scratch_path, spread
from ..sources import collection as store
from ..sources.files import list_files, with_source_names, write_files
from ..sources.jsonl import corrupt_run_lines, read_chunk_runs
from ..streaming.compaction import base_of, compact
from ..streaming.ingest import current_rows, ingest_stream
from . import ingest
from .retry import RetryConfig, Retried, parse_with_retries

#: Models of one collection and their dimensions.
MODELS = {"short": 64, "long": 384}
PARSE = ParseConfig(blocks_per_worker=1, timeout_s=120)


#: Folders over which the documents' files are dealt.
FOLDERS = 64


def document_files(spark: SparkSession, sf: str, shown: Column | None = None) -> DataFrame:
    """Every document as a text file of its own, listed and named; ``shown`` is what a file says."""
    path = scratch_path(spark, "files")
    docs = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    folder = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDERS)).cast("string")
    name = F.concat(folder, F.lit("/doc_id="), F.col("doc_id").cast("string"), F.lit(".txt"))
    value = F.coalesce(shown if shown is not None else F.col("text"), F.lit(""))
    write_files(docs.select(name.alias("name"), F.concat(value, F.lit("\n")).alias("content")), path)
    local = path.removeprefix("file://") if path.startswith("file:///") else path
    return with_source_names(list_files(spark, local, ".txt"), local)


def doc_of(source_key: Column) -> Column:
    return F.regexp_extract(source_key, "doc_id=([0-9]+)[.]", 1).cast("long")


def line_parser():
    """Text files: one page, each line a unit. The file ends in a line break of its own."""

    def parse(content: bytes, name: str):
        text = content.decode().removesuffix("\n")
        return 1, [{"text": line} for line in text.split("\n") if line.strip()]

    return parse


def _stored(spark: SparkSession, config: CollectionConfig) -> DataFrame:
    rows = store.open_collection(spark, config)
    return rows.select(doc_of(F.col("source_key")).alias("doc_id"), "chunk_index", "text")


def two_step_collection(spark, sf):
    """Files to chunk files, chunk files to a collection, and the collection read back."""
    config = CollectionConfig("two_step_collection")
    path = scratch_path(spark, "chunks")
    ingest.parse_step(document_files(spark, sf), line_parser, path, PARSE)
    ingest.load_step(read_chunk_runs(spark, path), config)
    return _stored(spark, config)


def one_step_collection(spark, sf):
    config = CollectionConfig("one_step_collection")
    ingest.single_step(document_files(spark, sf), line_parser, config, parse=PARSE)
    return _stored(spark, config)


def pipeline_log(spark, sf):
    """The log of the one step, with what the collection holds of each document."""
    log = ingest.single_step(document_files(spark, sf), line_parser, CollectionConfig("pipeline_log"), parse=PARSE)
    return log.select(doc_of(F.col("source_key")).alias("doc_id"), "status", "chunk_count", "chunks_inserted")


def collection_label(spark, sf):
    path = scratch_path(spark, "chunks")
    ingest.parse_step(document_files(spark, sf), line_parser, path, PARSE)
    return ingest.load_step(read_chunk_runs(spark, path), CollectionConfig("labelled")).toDF("label")


def troubled_parser():
    """Documents say what is to happen."""

    def parse(content: bytes, name: str):
        text = content.decode().strip()
        if text == "hang":
            time.sleep(600)
        if text == "raise":
            raise ValueError("cannot read this file")
        return 2, [] if text == "nothing" else [{"text": text}]

    return parse


def parse_outcomes(spark, sf):
    """One bad file doesn't stop the others: error, empty file, nothing found, time limit."""
    say = (
        F.when(F.col("doc_id") == 5, "hang")
        .when(F.col("doc_id") % 7 == 1, "raise")
        .when(F.col("doc_id") % 7 == 2, "nothing")
        .otherwise("word")
    )
    config = ParseConfig(blocks_per_worker=1, timeout_s=2)
    rows = materialise(parse_files(document_files(spark, sf, say), troubled_parser, config), "parsed")
    return rows.select(
        doc_of(F.col("source_key")).alias("doc_id"), "status", F.col("page_count").cast("long").alias("page_count"), "error",
        (F.length("actor_host") > 0).alias("has_host"), (F.col("duration_s") >= 2).alias("slow"),
    )


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    from .catalogue import documents, packed
    from ..operators.chunking import explode_chunks

    docs = documents(spark, sf).select(F.col("doc_id").cast("string").alias("source_key"), F.col("doc_id").cast("string").alias("source_file"), "text")
    return materialise(explode_chunks(packed(docs), ["source_key", "source_file"]), "chunks")


def collection_lifecycle(spark, sf):
    """Create, append, list, find, describe, load and drop; each fact is a row."""
    config = CollectionConfig("lifecycle")
    rows, _ = ingest.collection_rows(_chunks(spark, sf), config)
    even = F.col("chunk_index") % 2 == 0
    store.drop(spark, config)
    facts = [("exists before", str(store.exists(spark, config)).lower())]
    store.create_or_replace(rows, config)  # is replaced at once
    store.create_or_replace(rows.filter(even), config)
    store.append(rows.filter(~even), config)
    facts += [
        ("exists", str(store.exists(spark, config)).lower()),
        ("listed", str(config.name in store.collections(spark)).lower()),
        ("found in", store.find_database(spark, config.name)),
        ("rows", str(store.count_rows(spark, config).head()[0])),
        ("columns", ",".join(r.col_name for r in store.describe(spark, config).collect())),
        ("loaded rows", str((loaded := store.load(spark, config)).count())),
    ]
    loaded.unpersist()
    store.drop(spark, config)
    facts.append(("exists after", str(store.exists(spark, config)).lower()))
    return spark.createDataFrame(facts, "fact string, value string")


def append_incremental(spark, sf):
    """Half of the chunks loaded, all of them appended, twice: each is there once."""
    config = CollectionConfig("incremental")
    chunks = _chunks(spark, sf)
    vectors = embed(chunks, None, dim=config.dim)
    centroids = Centroids(train_centroids(vectors, 4, iterations=2))
    ingest.load_step(chunks.filter("chunk_index % 2 = 0"), config, centroids=centroids)
    for _ in range(2):
        ingest.append_indexed(chunks, config, centroids)
    rows = store.open_collection(spark, config)
    return rows.select(F.col("source_file").cast("long").alias("doc_id"), "chunk_index", "text")


def ivf_stored_recall(spark, sf):
    """Trained cells, a collection stored by cell, and a search that reads as many cells as the recall asks for."""
    from .catalogue import _self_queries, _trained

    config = CollectionConfig("stored_cells")
    indexed, centroids, nprobe = _trained(spark, sf)
    store.create_or_replace(indexed.withColumnRenamed("vec_id", "id"), config, CELL)
    stored, asked = store.open_collection(spark, config), _self_queries(spark, sf)
    near = probed_top_k(stored, asked, centroids, ["id"], config=SearchConfig(nprobe=nprobe))
    found = recall(top_k(stored, asked, ["id"]), near, ["id"])
    return found.withColumn("recall", F.round("recall", 6))


def _two_versions(spark: SparkSession, sf: str) -> str:
    """Documents taken by a stream, some of them again with another text or with none; the folder it went to."""
    base = scratch_path(spark, "versions")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    changed = docs.filter("doc_id % 10 < 2").withColumn("text", F.when(F.col("doc_id") % 10 == 0, "second version").otherwise(""))
    for version in (docs, changed):
        version.write.mode("append").parquet(f"{base}/in")
        query = ingest_stream(
            spark, f"{base}/in", f"{base}/rows", f"{base}/checkpoint", file_format="parquet",
            blocks=spark.sparkContext.defaultParallelism,
        )
        query.awaitTermination()
    return f"{base}/rows"


def _by_document(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("source_file").cast("long").alias("doc_id"), "chunk_index", "text")


def stream_two_versions(spark, sf):
    return _by_document(current_rows(spark, _two_versions(spark, sf)))


def stream_compacted(spark, sf):
    """The same after a compaction: what is stored now, without choosing among versions."""
    target = _two_versions(spark, sf)
    number = compact(spark, target).first()["snapshot"]
    return _by_document(spark.read.parquet(f"{base_of(target)}/{number}/rows"))


def stream_compaction_report(spark, sf):
    """Live rows, documents and tombstones of a compaction, and how many rows the stream's batches had."""
    target = _two_versions(spark, sf)
    before = spark.read.parquet(target).agg(F.count("*").alias("streamed_rows")).first()[0]
    found = compact(spark, target)
    return found.select("live_rows", "documents", "tombstones", F.lit(before).alias("streamed_rows"))


def _flaky(n: int):
    """Attempt ``n`` of a parser that manages a document at the attempt that its first line names."""

    def make():
        def parse(content: bytes, name: str):
            wanted, _, text = content.decode().removesuffix("\n").partition("\n")
            if int(wanted) > n:
                raise ValueError(f"not before attempt {wanted}")
            return 1, [{"text": line} for line in text.split("\n") if line.strip()]

        return parse

    return make


def _retried(spark: SparkSession, sf: str) -> Retried:
    base = scratch_path(spark, "retried")
    shown = F.concat((F.col("doc_id") % 5 + 1).cast("string"), F.lit("\n"), F.col("text"))
    return parse_with_retries(document_files(spark, sf, shown), _flaky, f"{base}/chunks", f"{base}/log", RetryConfig(3), PARSE)


def retry_until_done(spark, sf):
    """The last attempt of every document, and whether it is in quarantine."""
    found = _retried(spark, sf)
    given_up = found.quarantine.select("source_key", F.lit(True).alias("quarantine"))
    rows = found.last.join(given_up, "source_key", "left")
    return rows.select(
        doc_of(F.col("source_key")).alias("doc_id"), F.col("attempt").cast("long").alias("attempt"), "status", "chunk_count", "error",
        F.coalesce("quarantine", F.lit(False)).alias("quarantine"),
    )


def retry_chunks(spark, sf):
    """The chunks of all documents that some attempt managed."""
    return _retried(spark, sf).chunks.select(doc_of(F.col("source_key")).alias("doc_id"), "chunk_index", "text")


def observed_run(spark, sf):
    """The report of a run, taken by the write that stores it."""
    from .catalogue import documents

    docs = documents(spark, sf).select(F.col("doc_id").cast("string").alias("key"), "text")
    run = ingest.chunk_documents(native_documents(line_units(docs, "text"), "key", "key"), collapsed=True)
    run, taken = observed(run)
    materialise(run, "observed")
    return observed_report(spark, taken)


def duration_quantiles(spark, sf):
    """Median and 95 % of the durations of each host over all days, from sketches by host and day."""
    from .catalogue import run_log

    log = run_log(spark, sf).withColumn("day", F.to_date("finished_at"))
    sketches = materialise(duration_sketches(log, ["actor_host", "day"]), "sketches")
    return merged_quantiles(sketches, ["actor_host"])


def models_keyed_topk(spark, sf):
    """One collection with vectors of two models of different length, and questions for both in one search."""
    config = CollectionConfig("two_dimensions")
    chunks, asked = _chunks(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = [
        chunks.select(F.col("source_file").cast("long").alias("source_file"), "chunk_index", hashed_vectors(F.col("text"), dim).alias("embedding"), F.lit(m).alias("model"))
        for m, dim in MODELS.items()
    ]
    rows = rows[0].unionByName(rows[1]).withColumn("id", F.xxhash64("model", "source_file", "chunk_index"))
    store.create_or_replace(rows, config, "model")
    questions = [
        asked.select(F.concat(F.lit(f"{m}-"), F.col("item_id").cast("string")).alias("qid"), F.lit(m).alias("model"), hashed_vectors(F.col("text"), dim).alias("embedding"))
        for m, dim in MODELS.items()
    ]
    found = top_k_by_model(store.open_collection(spark, config), materialise(questions[0].unionByName(questions[1]), "asked"), ["source_file", "chunk_index"])
    return found.withColumn("score", F.round("score", 6))


def letters_encoder():
    """A tiny local model: how often each of eight letters occurs."""
    return lambda texts: [[float(t.lower().count(c)) for c in "etaoinsh"] for t in texts]


def letters_service():
    """The same behind an endpoint, whose replies come in reverse order."""
    encode = letters_encoder()

    def post(payload: dict) -> dict:
        found = encode(payload["input"])
        return {"data": [{"index": i, "embedding": v} for i, v in reversed(list(enumerate(found)))]}

    return post


def embedder_modes(spark, sf):
    """The endpoint and the local model give the same vectors."""
    b = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    local = embed(b, LocalEmbedder(letters_encoder, normalize=False), out="local")
    both = embed(local, EndpointEmbedder(letters_service, "letters", sub_batch=7), out="remote")
    numbers = lambda c: F.transform(c, lambda x: x.cast("long"))
    return both.select("item_id", F.array_join(numbers("local"), ",").alias("local"), F.array_join(numbers("remote"), ",").alias("remote"))


def several_models(spark, sf):
    """One collection written by two models; each is asked for by name."""
    b = spark.read.parquet(f"{sf}/benchmark.parquet")
    chunks = b.select(F.col("item_id").cast("string").alias("source_file"), F.lit(0).cast("long").alias("chunk_index"), "text")
    config = CollectionConfig("several_models", dim=8)
    for i, name in enumerate(("first", "second")):
        rows, _ = ingest.collection_rows(chunks, config, LocalEmbedder(letters_encoder), name)
        (store.append if i else store.create_or_replace)(rows, config)
    rows = store.open_collection(spark, config)
    return ingest.of_model(rows, "second").select(F.col("source_file").cast("long").alias("item_id"), "model")


class Refused(Exception):
    """A request that is wrong for good."""


def moody_service():
    """Letters behind an endpoint that is busy at every third request and refuses texts of some lengths."""
    encode, asked = letters_encoder(), iter(range(1 << 62))

    def post(payload: dict) -> dict:
        if next(asked) % 3 == 0:
            raise ConnectionError("busy")
        if any(len(t) % 7 == 0 for t in payload["input"]):
            raise Refused("refused")
        return {"data": [{"index": i, "embedding": v} for i, v in enumerate(encode(payload["input"]))]}

    return post


def endpoint_pipelined(spark, sf):
    """Vectors from a service with transient failures; what it refuses is a row with an error."""
    b = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    found = embed_or_error(b, PipelinedEndpoint(moody_service, "letters", sub_batch=1, window=4, attempts=50, pause_s=0.0001, most_pause_s=0.001))
    vector = F.array_join(F.transform("embedding", lambda x: x.cast("long")), ",")
    return found.select("item_id", vector.alias("vector"), "error")


PACKED_TASKS = 24


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    files = docs.select(F.col("doc_id").alias("source_key"), F.octet_length("text").cast("long").alias("length"))
    return pack(materialise(with_cost(files), "files"), PACKED_TASKS)


def packed_tasks(spark, sf):
    """The documents, taken as files, packed into tasks of equal size."""
    return _packed(spark, sf).select(F.col("source_key").alias("doc_id"), F.col("task").cast("long").alias("task"))


def packed_balance(spark, sf):
    """The greatest task against the mean, and against the mean with one greatest file more."""
    tasks = _packed(spark, sf).groupBy("task").agg(F.sum("cost").alias("cost"), F.max("cost").alias("file"), F.count("*").alias("files"))
    mean = F.sum("cost") / PACKED_TASKS
    return tasks.agg(F.count("*").alias("tasks"), F.sum("files").alias("files"), F.round(F.max("cost") / mean, 6).alias("greatest_to_mean"))


def chunk_lines_account(spark, sf):
    """Chunk files from elsewhere, some of whose lines are broken: what can be read and what can't, by run."""
    base = scratch_path(spark, "foreign")
    chunks = _chunks(spark, sf).select("source_file", "chunk_index", "text")
    whole = F.to_json(F.struct("source_file", "chunk_index", "text"))
    broken = (
        F.when(F.col("source_file").cast("long") % 10 == 3, F.left(whole, F.length(whole) - 2))
        .when(F.col("source_file").cast("long") % 10 == 4, F.to_json(F.struct("source_file", "text")))
        .otherwise(whole)
    )
    run = F.concat(F.lit("run-"), (F.col("source_file").cast("long") % 2).cast("string"))
    chunks.select(broken.alias("value"), run.alias("run_id")).write.partitionBy("run_id").option("compression", "none").text(base)
    good = read_chunk_runs(spark, base, "*.txt").groupBy("run_id").agg(F.count("*").alias("lines"))
    bad = corrupt_run_lines(spark, base, "*.txt").groupBy("run_id").agg(F.count("*").alias("lines"))
    return good.withColumn("readable", F.lit(True)).unionByName(bad.withColumn("readable", F.lit(False)))


class Answering:
    """A generator that says its name and how long the prompt is."""

    def __init__(self, name: str):
        self.name = name

    def load(self):
        return lambda prompt: f"{self.name}: {len(prompt)}"


def generator_per_query(spark, sf):
    b = spark.read.parquet(f"{sf}/benchmark.parquet")
    model = F.element_at(F.array(F.lit("small"), F.lit("large"), F.lit("unknown")), (F.col("item_id") % 3 + 1).cast("int"))
    asked = b.select("item_id", model.alias("model"), F.col("text").alias("prompt"))
    return generated_by_model(asked, {n: Answering(n) for n in ("small", "large")}).select("item_id", "model", "answer")


QUERIES = {
    f.__name__: f
    for f in (
        two_step_collection,
        one_step_collection,
        pipeline_log,
        collection_label,
        parse_outcomes,
        collection_lifecycle,
        append_incremental,
        stream_two_versions,
        stream_compacted,
        stream_compaction_report,
        retry_until_done,
        retry_chunks,
        observed_run,
        duration_quantiles,
        models_keyed_topk,
        endpoint_pipelined,
        packed_tasks,
        packed_balance,
        chunk_lines_account,
        ivf_stored_recall,
        embedder_modes,
        several_models,
        generator_per_query,
    )
}
