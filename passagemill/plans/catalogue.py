"""The registered queries: each operator over the given tables, whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import NLIST, CollectionConfig, SearchConfig
from ..functions.status import known_status, stored_error
from ..functions.text import base_name, cache_name, not_blank, preview, service_name, stem, token_count
from ..functions.vectors import has_dim, l2_normalize
from ..operators import reports
from ..operators.cells import lloyd_centroids, probes_for_recall
from ..operators.chunking import (
    chunk_count,
    explode_chunks,
    greedy_chunks,
    numbered,
    token_windows,
    tokenizer_count,
)
from ..operators.embedding import embed, hashed_vectors, vectors_of_reply
from ..operators.generation import extractive_answer, generated
from ..operators.ivf import (
    CELL,
    Centroids,
    assign_cells,
    nlist_rule,
    probed_top_k,
    recall,
    train_centroids,
)
from ..operators.prompting import build_prompts
from ..operators.search import gather_hits, top_k, top_k_of
from ..operators.units import explode_units, html_units, line_units
from ..session import is_folder, materialise, scratch_path, spread
from ..sources.collection import query as collection_query
from ..sources.collection import text_problem
from ..sources.files import first_files
from ..sources.jsonl import read_chunk_runs, write_chunk_run
from . import ask

EXACT = SearchConfig()


# ---- inputs ---------------------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(_table(spark, sf, "documents", "doc_id", "text"))


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """The events table in the shape of a run log."""
    e = _table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    status = (
        F.when((F.col("event_type") == "error") & (F.col("value") >= 100), "timeout")
        .when(F.col("event_type") == "error", "error")
        .when(F.col("event_type") == "signup", "empty")
        .otherwise("success")
    )
    return e.withColumn("status", status).select(
        F.concat(F.lit("doc-"), F.col("event_id").cast("string"), F.lit(".pdf")).alias("source_file"),
        "status",
        F.when(F.col("status").isin("success", "empty"), k).otherwise(0).alias("page_count"),
        F.when(F.col("status") == "success", k).otherwise(0).alias("chunk_count"),
        F.when(F.col("status") == "timeout", "Timed out after 600s")
        .when(F.col("status") == "error", F.concat(F.lit("bad event "), F.col("event_id").cast("string")))
        .when(F.col("status") == "empty", "No chunks produced")
        .otherwise("")
        .alias("error"),
        F.col("value").alias("duration_s"),
        F.concat(F.lit("host-"), (F.col("user_id") % 8).cast("string")).alias("actor_host"),
        F.col("ts").alias("finished_at"),
    )


def windows(df: DataFrame) -> DataFrame:
    return token_windows(df, "text")


def packed(df: DataFrame) -> DataFrame:
    return greedy_chunks(line_units(df, "text"), collapsed=True)


def chunk_vectors(docs: DataFrame, chunker) -> DataFrame:
    """Chunks of documents with whole-number vectors, whose cosines are exact."""
    rows = explode_chunks(chunker(docs).withColumnRenamed("doc_id", "source_file"), ["source_file"])
    return rows.select("source_file", "chunk_index", hashed_vectors(F.col("text")).alias("embedding"))


def rag_hits(spark: SparkSession, sf: str, chunker) -> DataFrame:
    """Hits with their texts: chunks are stored once, vectors are searched, texts joined to the winners."""
    docs = documents(spark, sf).withColumnRenamed("doc_id", "source_file")
    chunks = materialise(explode_chunks(chunker(docs), ["source_file"]), "chunks")
    vectors = chunks.select("source_file", "chunk_index", hashed_vectors(F.col("text")).alias("embedding"))
    found = ask.retrieve(vectors, questions(spark, sf), normalize=False, config=EXACT)
    return ask.with_text(found, chunks, ask.KEYS, ("text",))


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    return build_prompts(gather_hits(questions(spark, sf), rag_hits(spark, sf, windows)))


# ---- text, units, chunks ----------------------------------------------------------------


def nonblank_lines(spark, sf):
    lines = documents(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.filter(not_blank(F.col("line"))).select("doc_id", F.col("line_no").cast("long"), "line")


def doc_units(spark, sf):
    return explode_units(line_units(documents(spark, sf), "text"), ["doc_id"])


def page_units(spark, sf):
    pages = spread(_table(spark, sf, "pages", "page_id", "html"))
    return explode_units(html_units(pages, "html"), ["page_id"])


def page_chunks(spark, sf):
    pages = spread(_table(spark, sf, "pages", "page_id", "html"))
    return explode_chunks(greedy_chunks(html_units(pages, "html"), collapsed=True), ["page_id"])


def token_counts(spark, sf):
    return documents(spark, sf).select("doc_id", token_count(F.col("text")).alias("n_tokens"))


def four_letters():
    """A stand-in for a sub-word tokenizer: pieces of at most four characters."""
    import re

    return lambda text: [m.span() for m in re.finditer(r"[^ \t\n\x0b\f\r]{1,4}", text)]


def tokenizer_counts(spark, sf):
    return documents(spark, sf).select("doc_id", tokenizer_count(F.col("text"), four_letters).alias("n_tokens"))


def tokenizer_chunks(spark, sf):
    """Packing bounded by a tokenizer's count instead of words."""
    docs = greedy_chunks(line_units(documents(spark, sf), "text"), make_tokenizer=four_letters)
    return explode_chunks(docs, ["doc_id"])


def token_windows_query(spark, sf):
    return explode_chunks(windows(documents(spark, sf)), ["doc_id"])


def greedy_chunks_query(spark, sf):
    return explode_chunks(packed(documents(spark, sf)), ["doc_id"])


def chunk_index_modes(spark, sf):
    lines = documents(spark, sf).select("doc_id", numbered(F.split("text", "\n"), "position").alias("lines"))
    return lines.select("doc_id", F.posexplode("lines").alias("dense_index", "c")).select(
        "doc_id",
        F.col("c.chunk_index").alias("position_index"),
        F.col("dense_index").cast("long").alias("dense_index"),
        F.col("c.text").alias("text"),
    )


def chunks_per_doc(spark, sf):
    return packed(documents(spark, sf)).select("doc_id", chunk_count(F.col("chunks")).alias("n_chunks"))


def corpus_size(spark, sf):
    return reports.corpus_size(packed(documents(spark, sf)))


# ---- embedding ----------------------------------------------------------------------------


def hashed_embedding(spark, sf):
    vectors = embed(questions(spark, sf), text="question", normalize=False)
    return (
        vectors.select("qid", F.posexplode("embedding").alias("dim", "v"))
        .filter("v <> 0")
        .select("qid", F.col("dim").cast("long").alias("dim"), F.col("v").cast("long").alias("v"))
    )


def chunk_embedding(spark, sf):
    """A digest of each chunk's vector, folded on its row."""
    start = F.struct(*[F.lit(0).cast("long").alias(n) for n in ("pos", "nonzero", "energy", "weighted")])

    def step(acc, x):
        v = x.cast("long")
        return F.struct(
            (acc["pos"] + 1).alias("pos"),
            (acc["nonzero"] + (v != 0).cast("long")).alias("nonzero"),
            (acc["energy"] + v * v).alias("energy"),
            (acc["weighted"] + v * (acc["pos"] + 1)).alias("weighted"),
        )

    rows = chunk_vectors(documents(spark, sf), windows)
    return rows.select(
        F.col("source_file").alias("doc_id"), "chunk_index", F.aggregate("embedding", start, step).alias("d")
    ).select("doc_id", "chunk_index", "d.nonzero", "d.energy", "d.weighted")


def l2_normalize_query(spark, sf):
    return (
        _table(spark, sf, "embeddings")
        .select("vec_id", F.posexplode(l2_normalize(F.col("embedding"))).alias("pos", "x"))
        .select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x"))
    )


def dim_validation(spark, sf):
    e = _table(spark, sf, "embeddings")
    return e.groupBy(has_dim(F.col("embedding"), 64).alias("valid")).agg(F.count("*").alias("vectors"))


def response_reorder(spark, sf):
    """Replies that list the vectors of a label by falling id, put in order again."""
    e = _table(spark, sf, "embeddings", "vec_id", "embedding")
    two = F.array(
        F.struct(F.reverse("embedding").cast("array<double>").alias("embedding"), F.lit(1).alias("index")),
        F.struct(F.col("embedding").cast("array<double>").alias("embedding"), F.lit(0).alias("index")),
    )
    replies = e.select("vec_id", F.to_json(F.struct(two.alias("data"))).alias("reply"))
    vectors = replies.select("vec_id", F.posexplode(vectors_of_reply(F.col("reply"))).alias("index", "v"))
    return vectors.select(
        "vec_id",
        F.col("index").cast("long").alias("index"),
        F.round(F.element_at("v", 1), 6).alias("first"),
        F.round(F.element_at("v", -1), 6).alias("last"),
    )


# ---- search ---------------------------------------------------------------------------------


def _vectors(spark, sf):
    return spread(_table(spark, sf, "embeddings", "vec_id", "embedding"))


def _self_queries(spark, sf):
    return _table(spark, sf, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")


def _rounded(hits):
    return hits.withColumn("score", F.round("score", 6))


def topk_single(spark, sf):
    vectors = _vectors(spark, sf)
    first = vectors.orderBy("vec_id").limit(1).head()
    return _rounded(top_k_of(vectors, first["embedding"], ["vec_id"]))


def topk_batch(spark, sf):
    return _rounded(top_k(_vectors(spark, sf), _self_queries(spark, sf), ["vec_id"]))


def topk_blocks(spark, sf):
    """The same search on the path for query tables too large to ship."""
    config = SearchConfig(broadcast_bytes=0, block_rows=200, block_queries=300)
    return _rounded(top_k(_vectors(spark, sf), _self_queries(spark, sf), ["vec_id"], config=config))


def topk_filtered(spark, sf):
    """Search among the vectors that a scalar filter leaves."""
    kept = collection_query(spread(_table(spark, sf, "embeddings")), "label >= 5")
    return _rounded(top_k(kept, _self_queries(spark, sf), ["vec_id"]))


def nlist_query(spark, sf):
    return _table(spark, sf, "embeddings").agg(nlist_rule(F.count("*")).alias("nlist"))


#: Share of the exact hits that a probed search is to find, and about how many queries measure it.
TARGET_RECALL = 0.92
MEASURED_QUERIES = 1000
_trained_cells: dict[tuple[str, str], tuple] = {}


def _trained(spark, sf):
    """Vectors with their cell, centroids, and the number of cells to probe: trained once a session and table."""
    made = (spark.sparkContext.applicationId, sf)
    if made not in _trained_cells:
        vectors = _vectors(spark, sf)
        rows = vectors.count()
        nlist = vectors.agg(nlist_rule(F.count("*")).alias("n")).head()["n"]
        centroids = Centroids(lloyd_centroids(vectors, "vec_id", nlist))
        indexed = materialise(assign_cells(vectors, centroids), "cells")
        asked = _self_queries(spark, sf).where(F.col("qid") % max(1, rows // MEASURED_QUERIES) == 0)
        _trained_cells[made] = indexed, centroids, probes_for_recall(indexed, centroids, asked, ["vec_id"], TARGET_RECALL)
    return _trained_cells[made]


def ivf_assign(spark, sf):
    indexed, _, _ = _trained(spark, sf)
    return indexed.select("vec_id", F.col(CELL).cast("long").alias(CELL))


def ivf_topk(spark, sf):
    indexed, centroids, nprobe = _trained(spark, sf)
    return _rounded(probed_top_k(indexed, _self_queries(spark, sf), centroids, ["vec_id"], config=SearchConfig(nprobe=nprobe)))


def ivf_blocks(spark, sf):
    """Probed search on the path for query tables too large to ship."""
    indexed, centroids, nprobe = _trained(spark, sf)
    config = SearchConfig(nprobe=nprobe, broadcast_bytes=0, block_rows=20, block_queries=50)
    return _rounded(probed_top_k(indexed, _self_queries(spark, sf), centroids, ["vec_id"], config=config))


def ivf_recall(spark, sf):
    indexed, centroids, nprobe = _trained(spark, sf)
    asked = _self_queries(spark, sf)
    exact = top_k(indexed, asked, ["vec_id"])
    near = probed_top_k(indexed, asked, centroids, ["vec_id"], config=SearchConfig(nprobe=nprobe))
    return recall(exact, near, ["vec_id"]).withColumn("recall", F.round("recall", 6))


def ivf_trained_full_probe(spark, sf):
    """KMeans cells, all of them probed: must equal exact search."""
    vectors = _vectors(spark, sf)
    centroids = Centroids(train_centroids(vectors, 22))
    config = SearchConfig(nprobe=NLIST)
    return _rounded(
        probed_top_k(assign_cells(vectors, centroids), _self_queries(spark, sf), centroids, ["vec_id"], config=config)
    )


# ---- questions to answers -------------------------------------------------------------------------


def context_block_query(spark, sf):
    return prompts(spark, sf).select("qid", "context")


def build_prompt(spark, sf):
    return prompts(spark, sf).select("qid", "prompt")


def prompt_length(spark, sf):
    return prompts(spark, sf).select("qid", F.length("prompt").cast("long").alias("prompt_length"))


def extractive_answer_query(spark, sf):
    gathered = gather_hits(questions(spark, sf), rag_hits(spark, sf, windows))
    return gathered.select("qid", extractive_answer(F.col("hits")).alias("answer"))


def rag_sources(spark, sf):
    return ask.sources(rag_hits(spark, sf, windows))


def rag_retrieval(spark, sf):
    """Retrieval only, with the start of each hit."""
    return ask.inspect_hits(rag_hits(spark, sf, windows))


def rag_end_to_end(spark, sf):
    """Flagship: documents, greedy chunks, vectors, search, prompt, answer."""
    answered = ask.answer(questions(spark, sf), rag_hits(spark, sf, packed))
    return answered.select(
        "qid", "question", "answer", F.size("sources").cast("long").alias("n_sources"), "prompt"
    )


class EchoGenerator:
    """Stands in for a model where none is installed: the first line of the prompt."""

    def load(self):
        return lambda prompt: prompt.split("\n")[0]


def rag_vs_direct(spark, sf):
    answered = ask.answer(questions(spark, sf), rag_hits(spark, sf, windows))
    return ask.rag_against_direct(answered, EchoGenerator())


def generated_answers(spark, sf):
    return questions(spark, sf).select("qid", generated(F.col("question"), EchoGenerator()).alias("answer"))


def clean_questions_query(spark, sf):
    c = _table(spark, sf, "conversations").filter("role = 'user'")
    return ask.clean_questions(c.select("conv_id", "turn", F.col("text").alias("question")))


# ---- reports --------------------------------------------------------------------------------------


def doc_status(spark, sf):
    return run_log(spark, sf).select(
        "source_file", known_status(F.col("status")).alias("status"), "page_count", "chunk_count",
        stored_error(F.col("error")).alias("error"),
    )


def run_report(spark, sf):
    return reports.run_report(run_log(spark, sf))


def worker_distribution(spark, sf):
    return reports.worker_distribution(run_log(spark, sf))


def source_distribution(spark, sf):
    return reports.worker_distribution(_table(spark, sf, "documents", "source"), "source")


def first_errors(spark, sf):
    return reports.first_errors(run_log(spark, sf))


def throughput(spark, sf):
    return reports.throughput(run_log(spark, sf))


def progress_eta(spark, sf):
    return reports.progress(run_log(spark, sf))


def output_objects(spark, sf):
    return reports.output_objects(run_log(spark, sf))


def reconcile(spark, sf):
    """Chunks that packing promises against the windows that a collection holds."""
    docs = documents(spark, sf)
    expected = packed(docs).select("doc_id", chunk_count(F.col("chunks")).alias("chunk_count"))
    return reports.reconcile(expected, explode_chunks(windows(docs), ["doc_id"]), "doc_id")


def health_alerts(spark, sf):
    return reports.health_alerts(run_log(spark, sf))


def error_capture(spark, sf):
    """A value that cannot be read becomes an error row; the job goes on."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    e = _table(spark, sf, "events")
    small = F.when(k < 50, k.cast("string")).otherwise(F.concat(F.lit("k"), k.cast("string")))
    return e.select("event_id", small.alias("raw")).select(
        "event_id",
        F.when(F.col("raw").try_cast("int").isNull(), "error").otherwise("success").alias("status"),
        F.col("raw").try_cast("int").cast("long").alias("value"),
        F.when(F.col("raw").try_cast("int").isNull(), F.concat(F.lit("not a number: "), "raw")).otherwise("").alias("error"),
    )


# ---- sources, collections -------------------------------------------------------------------------


def scan_first_n(spark, sf):
    pages = _table(spark, sf, "pages", "url", "page_id").withColumnRenamed("url", "path")
    return first_files(pages.select("path", "page_id"), 25, ("path", "page_id"))


def empty_source_status(spark, sf):
    d = _table(spark, sf, "documents", "doc_id", "text")
    length = F.octet_length("text")
    return d.select(
        "doc_id",
        length.cast("long").alias("length"),
        F.when(length == 0, "error").otherwise("success").alias("status"),
        F.when(length == 0, "File empty").otherwise("").alias("error"),
    )


def jsonl_roundtrip(spark, sf):
    """Chunks written as chunk files, one folder per data source, and read back."""
    docs = spread(_table(spark, sf, "documents", "doc_id", "source", "text"))
    rows = explode_chunks(windows(docs), ["doc_id", "source"]).select(
        F.col("source").alias("source_key"), F.col("doc_id").cast("string").alias("source_file"), "chunk_index", "text"
    )
    path = scratch_path(spark, "chunks")
    write_chunk_run(rows, path, "run")
    return read_chunk_runs(spark, path).select("source_file", "chunk_index", "text")


def collection_count(spark, sf):
    return collection_query(_table(spark, sf, "embeddings"), "", ["count(*)"]).withColumnRenamed("count(*)", "row_count")


def filtered_sample(spark, sf):
    e = _table(spark, sf, "embeddings").select("vec_id", "label")
    return collection_query(e, "label >= 5", ["vec_id", "label"], 5, ("vec_id",)).withColumn(
        "label", F.col("label").cast("long")
    )


def length_quarantine(spark, sf):
    """Which documents would be too long for a collection of the smaller text size."""
    d = _table(spark, sf, "documents", "doc_id", "text").withColumn("source_file", F.col("doc_id").cast("string"))
    problem = text_problem(CollectionConfig(max_text_bytes=8192))
    return d.select("doc_id", F.coalesce(problem, F.lit("")).alias("problem"))


def url_basename_stem(spark, sf):
    url = F.col("url")
    return _table(spark, sf, "pages", "page_id", "url").select(
        "page_id", base_name(url).alias("name"), stem(url).alias("stem")
    )


def text_preview(spark, sf):
    return _table(spark, sf, "documents", "doc_id", "text").select("doc_id", preview(F.col("text")).alias("preview"))


def safe_name(spark, sf):
    model = F.concat("source", F.lit("/"), "lang", F.lit("_v0.3"))
    return _table(spark, sf, "documents", "doc_id", "source", "lang").select(
        "doc_id", service_name(model).alias("service"), cache_name(model).alias("cache")
    )


def incremental_new(spark, sf):
    """Documents that the labels, taken as the log of an earlier run, do not cover."""
    done = _table(spark, sf, "labels", "doc_id")
    return _table(spark, sf, "documents", "doc_id", "n_chars").join(done, "doc_id", "left_anti")


def retry_failed(spark, sf):
    """Failed files of the run log with attempts left."""
    from .ingest import to_retry

    log = run_log(spark, sf)
    files = log.select("source_file", "duration_s")
    return to_retry(files, log.withColumn("attempt", F.lit(1)), 3, "source_file").select(
        "source_file", "duration_s", F.col("attempt").cast("long").alias("attempt")
    )


def stream_ingest(spark, sf):
    """The documents file taken by a stream, chunked, embedded and read back."""
    from ..streaming.ingest import current_rows, ingest_stream

    base = scratch_path(spark, "stream")
    # a stream takes the files of a folder: the table's own, if it has several, or one by name
    table = f"{sf}/documents.parquet"
    whole = is_folder(spark, table)
    query = ingest_stream(
        spark, table if whole else sf, f"{base}/rows", f"{base}/checkpoint", file_format="parquet",
        options={} if whole else {"pathGlobFilter": "documents.parquet"}, blocks=spark.sparkContext.defaultParallelism,
    )
    query.awaitTermination()
    return current_rows(spark, f"{base}/rows").select(
        "source_file", "chunk_index", "text", F.size("embedding").cast("long").alias("dim")
    )


QUERIES = {
    "rag_end_to_end": rag_end_to_end,
    "nonblank_lines": nonblank_lines,
    "doc_units": doc_units,
    "page_units": page_units,
    "page_chunks": page_chunks,
    "token_counts": token_counts,
    "tokenizer_counts": tokenizer_counts,
    "tokenizer_chunks": tokenizer_chunks,
    "token_windows": token_windows_query,
    "greedy_chunks": greedy_chunks_query,
    "chunk_index_modes": chunk_index_modes,
    "chunks_per_doc": chunks_per_doc,
    "corpus_size": corpus_size,
    "hashed_embedding": hashed_embedding,
    "chunk_embedding": chunk_embedding,
    "l2_normalize": l2_normalize_query,
    "dim_validation": dim_validation,
    "response_reorder": response_reorder,
    "topk_single": topk_single,
    "topk_batch": topk_batch,
    "topk_blocks": topk_blocks,
    "topk_filtered": topk_filtered,
    "nlist_rule": nlist_query,
    "ivf_assign": ivf_assign,
    "ivf_topk": ivf_topk,
    "ivf_blocks": ivf_blocks,
    "ivf_recall": ivf_recall,
    "ivf_trained_full_probe": ivf_trained_full_probe,
    "context_block": context_block_query,
    "build_prompt": build_prompt,
    "prompt_length": prompt_length,
    "extractive_answer": extractive_answer_query,
    "rag_sources": rag_sources,
    "rag_retrieval": rag_retrieval,
    "rag_vs_direct": rag_vs_direct,
    "generated_answers": generated_answers,
    "clean_questions": clean_questions_query,
    "doc_status": doc_status,
    "run_report": run_report,
    "worker_distribution": worker_distribution,
    "source_distribution": source_distribution,
    "first_errors": first_errors,
    "throughput": throughput,
    "progress_eta": progress_eta,
    "output_objects": output_objects,
    "reconcile": reconcile,
    "health_alerts": health_alerts,
    "error_capture": error_capture,
    "scan_first_n": scan_first_n,
    "empty_source_status": empty_source_status,
    "jsonl_roundtrip": jsonl_roundtrip,
    "collection_count": collection_count,
    "filtered_sample": filtered_sample,
    "length_quarantine": length_quarantine,
    "url_basename_stem": url_basename_stem,
    "text_preview": text_preview,
    "safe_name": safe_name,
    "incremental_new": incremental_new,
    "retry_failed": retry_failed,
    "stream_ingest": stream_ingest,
}
