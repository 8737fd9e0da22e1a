import os
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from passagemill.config import ChunkConfig, CollectionConfig, ParseConfig, SearchConfig
from passagemill.operators.batchmap import parse_files
from passagemill.operators.embedding import EndpointEmbedder
from passagemill.operators.generation import ChatEndpoint, NOT_IN_CONTEXT, generated_by_model
from passagemill.operators.ivf import Centroids, train_centroids
from passagemill.plans import ask
from passagemill.plans.ingest import (
    append_indexed, chunk_documents, chunk_rows, inspect, load_step, not_yet_processed, of_model, collection_rows,
    parse_step, run_log, single_step, to_retry,
)
from passagemill.sources import collection as store
from passagemill.sources.files import list_files, with_source_names
from passagemill.sources.jsonl import read_chunk_runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARSE = ParseConfig(workers=2, blocks_per_worker=2, timeout_s=2)


def make_parser():
    """Text files: each line a unit; a few words make it misbehave."""

    def parse(content, name):
        text = content.decode()
        if "HANG" in text:
            time.sleep(60)
        if "RAISE" in text:
            raise ValueError("cannot read " + "x" * 500)
        if "DIE" in text:
            os._exit(3)
        units = [{"text": line, "kind": "p"} for line in text.split("\n")] if text != "NOTHING" else []
        return 3, units

    return parse


FILES = {
    "a/x.pdf": "alpha beta\n\ngamma", "b/x.pdf": "delta", "empty.pdf": "", "none.pdf": "NOTHING", "blank.pdf": "\n\t \n ",
    "hang.pdf": "HANG", "raise.pdf": "RAISE", "die.pdf": "DIE", "_under.pdf": "epsilon " * 300,
}


@pytest.fixture()
def files(spark, tmp_path):
    root = tmp_path / "in"
    for name, text in FILES.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return with_source_names(list_files(spark, str(root)), str(root))


def test_every_file_gets_a_status(spark, files):
    chunked = chunk_documents(parse_files(files, make_parser, PARSE)).cache()
    log = {r["source_key"]: r for r in run_log(chunked).collect()}
    got = {k: (r["status"], r["page_count"], r["chunk_count"]) for k, r in log.items()}
    assert got == {
        "a/x.pdf": ("success", 3, 1), "b/x.pdf": ("success", 3, 1), "_under.pdf": ("success", 3, 2),
        "empty.pdf": ("error", 0, 0), "none.pdf": ("empty", 3, 0), "blank.pdf": ("empty", 3, 0),
        "hang.pdf": ("timeout", 0, 0), "raise.pdf": ("error", 0, 0), "die.pdf": ("error", 0, 0),
    }
    assert log["empty.pdf"]["error"] == "File empty"
    assert log["none.pdf"]["error"] == "No chunks produced"
    assert log["blank.pdf"]["error"] == "All chunks empty"
    assert log["hang.pdf"]["error"] == "Timed out after 2s" and log["hang.pdf"]["duration_s"] >= 2
    assert log["raise.pdf"]["error"].startswith("cannot read x") and len(log["raise.pdf"]["error"]) == 200
    assert all(r["actor_host"] for r in log.values())
    assert chunk_rows(chunked).count() == 4


def test_two_steps_equal_one_step(spark, files, tmp_path):
    key = ("source_file", "chunk_index", "text")
    path = str(tmp_path / "chunks")
    two, one = CollectionConfig("two_steps", "pipes"), CollectionConfig("one_step", "pipes")
    for _ in range(2):  # repeating a run changes nothing
        log = parse_step(files, make_parser, path, PARSE)
        assert load_step(read_chunk_runs(spark, path), two).head()[0] == "two_steps:4"
    assert log.count() == len(FILES)
    single_step(files, make_parser, one, parse=PARSE)
    a = sorted(tuple(r) for r in store.open_collection(spark, two).select(*key, "embedding").collect())
    b = sorted(tuple(r) for r in store.open_collection(spark, one).select(*key, "embedding").collect())
    assert a == b and len(a) == 4
    # files of the same name in two folders stay two sources, with the same ids both ways
    ids = [{r["id"] for r in store.open_collection(spark, c).select("id").collect()} for c in (one, two)]
    assert ids[0] == ids[1] and len(ids[0]) == 4
    asked = spark.createDataFrame([(1, "delta"), (2, "gamma beta")], "qid long, question string")
    answers = {r["qid"]: r for r in ask.ask(store.open_collection(spark, two), asked, config=SearchConfig(k=4)).collect()}
    assert all(len(r["sources"]) == 4 for r in answers.values())
    assert answers[1]["answer"] == "delta" and answers[2]["sources"][0]["text"] == "alpha beta\ngamma"


def test_error_limit_stops_the_job(spark, files, tmp_path):
    with pytest.raises(RuntimeError, match="of 9 files failed"):
        parse_step(files, make_parser, str(tmp_path / "c"), ParseConfig(2, 2, 2, max_error_rate=0.1))


def test_incremental_and_retry(spark):
    files = spark.createDataFrame(
        [("a", 1, 1.0), ("b", 1, 1.0), ("c", 2, 1.0)], "path string, length long, modified double"
    )
    done = files.filter("path <> 'c'").withColumn("length", F.when(F.col("path") == "b", 9).otherwise(F.col("length")))
    assert sorted(r["path"] for r in not_yet_processed(files, done).collect()) == ["b", "c"]
    log = spark.createDataFrame(
        [("a", 1, "error"), ("a", 2, "success"), ("b", 1, "timeout"), ("c", 1, "error"), ("c", 2, "error"), ("c", 3, "error")],
        "source_key string, attempt int, status string",
    )
    again = to_retry(files.withColumnRenamed("path", "source_key"), log, 3).collect()
    assert [(r["source_key"], r["attempt"]) for r in again] == [("b", 2)]


CHUNKS = [("f1", 0, "red green blue"), ("f1", 1, "red\nsecond line"), ("f2", 0, "yellow green"), ("f3", 0, "black white grey")]


def chunks(spark):
    return spark.createDataFrame(CHUNKS, "source_file string, chunk_index long, text string")


QUESTIONS = [(1, "red"), (2, "yellow green")]


def questions(spark):
    return spark.createDataFrame(QUESTIONS, "qid long, question string")


def test_questions_over_a_stored_collection(spark):
    config = CollectionConfig("asked", "pipes")
    load_step(chunks(spark), config)
    collection = store.open_collection(spark, config)
    rows = {r["qid"]: r for r in ask.ask(collection, questions(spark), config=SearchConfig(k=2)).collect()}
    assert rows[2]["sources"][0]["source_file"] == "f2" and rows[2]["answer"] == "yellow green"
    assert len(rows[1]["sources"]) == 2 and rows[1]["answer"] in ("red", "red green blue")
    score = rows[2]["sources"][0]["score"]
    assert rows[2]["prompt"] == (
        "You are a helpful assistant. Answer the user's question based on the provided context documents. "
        "If the answer is not in the context, say so.\n\n## Context\n\n"
        + "\n\n---\n\n".join(
            f"[Source: {s['source_file']}, chunk {s['chunk_index']}, score: {s['score']:.3f}]\n{s['text']}"
            for s in rows[2]["sources"]
        )
        + "\n\n## Question\n\nyellow green\n\n## Answer\n\n"
    )
    assert abs(score - 1.0) < 1e-6
    labelled = ask.ask(collection, questions(spark), label="similarity").head()["prompt"]
    assert ", similarity: " in labelled


def test_questions_without_hits(spark):
    empty = spark.createDataFrame([], "id long, source_file string, chunk_index long, text string, embedding array<float>")
    rows = ask.ask(empty, questions(spark)).collect()
    assert len(rows) == 2
    for r in rows:
        assert r["sources"] == [] and r["answer"] == NOT_IN_CONTEXT and "## Context\n\n\n\n## Question" in r["prompt"]


def test_generators(spark):
    def make_client():
        def post(payload):
            assert payload["temperature"] == 0.1 and payload["max_tokens"] == 512
            return {"choices": [{"message": {"content": f"{payload['model']}:{len(payload['messages'][0]['content'])}"}}]}

        return post

    a, b = ChatEndpoint(make_client, "a"), ChatEndpoint(make_client, "b")
    prompts = spark.createDataFrame([(1, "a", "xx"), (2, "b", "yyy"), (3, "c", "z"), (4, None, "z")], "qid long, model string, prompt string")
    got = {r["qid"]: r["answer"] for r in generated_by_model(prompts, {"a": a, "b": b}).collect()}
    assert got == {1: "a:2", 2: "b:3", 3: None, 4: None}
    rag = spark.createDataFrame([(1, "q?", "ctx answer")], "qid long, question string, answer string")
    r = ask.rag_against_direct(rag, a).head()
    assert (r["rag_answer"], r["direct_answer"]) == ("ctx answer", "a:2")


def test_clean_questions(spark):
    df = spark.createDataFrame([("  what? ",), ("QUIT",), (" q ",), ("",), ("\n",), ("exit now",)], "question string")
    assert [r[0] for r in ask.clean_questions(df).collect()] == ["what?", "exit now"]


def test_incremental_index(spark):
    config = CollectionConfig("growing", "pipes")
    rows, _ = collection_rows(chunks(spark), config)
    centroids = Centroids(train_centroids(rows, 2))
    load_step(chunks(spark), config, centroids=centroids)
    more = spark.createDataFrame([("f9", 0, "purple"), CHUNKS[0]], "source_file string, chunk_index long, text string")
    for _ in range(2):
        append_indexed(more, config, centroids)
    table = store.open_collection(spark, config)
    assert table.count() == 5 and table.select("id").distinct().count() == 5
    asked = spark.createDataFrame([(1, "purple")], "qid long, question string")
    hit = ask.ask(table, asked, config=SearchConfig(nprobe=2, k=1), centroids=centroids).head()
    assert hit["sources"][0]["source_file"] == "f9"


def test_several_models_side_by_side(spark):
    config = CollectionConfig("models", "pipes", 2)

    def make_client():
        return lambda p: {"data": [{"index": i, "embedding": [1.0, len(t)]} for i, t in enumerate(p["input"])]}

    rows, _ = collection_rows(chunks(spark), config, EndpointEmbedder(make_client, "m2"), model="m2")
    other, _ = collection_rows(chunks(spark), config, EndpointEmbedder(make_client, "m1"), model="m1")
    store.create_or_replace(rows.unionByName(other), config, "model")
    assert of_model(store.open_collection(spark, config), "m1").count() == 4


def test_inspection(spark):
    config = CollectionConfig("seen", "pipes")
    load_step(chunks(spark), config)
    there = inspect(spark, CollectionConfig("seen", "default"))
    assert there["exists"] and there["database"] == "pipes" and there["row_count"].head()[0] == 4
    assert there["sample"].count() == 4
    gone = inspect(spark, CollectionConfig("never", "pipes"))
    assert not gone["exists"] and "seen" in gone["collections"]


def test_nothing_to_load(spark):
    config = CollectionConfig("nothing", "pipes")
    with pytest.raises(FileNotFoundError):
        load_step(chunks(spark).limit(0), config)
    assert load_step(chunks(spark).limit(0), config, allow_empty=True).head()[0] == "nothing:0"


def test_dense_and_position_index(spark):
    parsed = spark.createDataFrame([(1, ["a", " ", "b"])], "source_key int, chunks array<string>").withColumn("source_file", F.lit("f"))
    assert sorted(r["chunk_index"] for r in chunk_rows(parsed, "dense").collect()) == [0, 1]
    assert sorted(r["chunk_index"] for r in chunk_rows(parsed, ChunkConfig().index_mode).collect()) == [0, 2]
