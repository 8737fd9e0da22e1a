import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from passagemill.config import CollectionConfig
from passagemill.sources import collection as store
from passagemill.sources.files import first_files, list_files, with_content, with_source_names
from passagemill.sources.jsonl import (
    NoChunks, corrupt_lines, read_chunk_runs, read_chunks, write_chunk_run, write_chunks,
)

CHUNK = "source_key string, source_file string, chunk_index long, text string"


def put(root, name, content=b"x"):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content)


@pytest.fixture()
def tree(tmp_path):
    root = str(tmp_path / "in")
    put(root, "empty.pdf", b"")
    put(root, "a/x.pdf", b"one")
    put(root, "b/x.pdf", b"two")
    put(root, "b/deep/er/_c.pdf", b"three")
    put(root, ".d.pdf")
    put(root, ".hidden/z.pdf")
    put(root, "E.PDF")
    put(root, "note.txt")
    return root


def test_listing_sees_what_a_shell_glob_sees(spark, tree):
    files = with_source_names(list_files(spark, tree), tree)
    got = {r["source_key"]: (r["source_file"], r["length"]) for r in files.collect()}
    assert got == {
        "empty.pdf": ("empty.pdf", 0), "a/x.pdf": ("x.pdf", 3), "b/x.pdf": ("x.pdf", 3),
        "b/deep/er/_c.pdf": ("_c.pdf", 5),
    }


def test_content_and_first_files(spark, tree):
    files = with_source_names(list_files(spark, tree), tree)
    got = {r["source_key"]: bytes(r["content"]) for r in with_content(files).collect()}
    assert got == {"empty.pdf": b"", "a/x.pdf": b"one", "b/x.pdf": b"two", "b/deep/er/_c.pdf": b"three"}
    assert [r["source_key"] for r in first_files(files, 2).collect()] == ["a/x.pdf", "b/deep/er/_c.pdf"]
    assert first_files(files, 0).count() == 4
    assert "TakeOrderedAndProject" in plan_of(first_files(files, 2))


def test_empty_folder(spark, tmp_path):
    assert list_files(spark, str(tmp_path)).isEmpty()


TEXTS = ["plain", "line\nbreak", "sep arator", "nb sp", "quote \" ' \\", "tab\t", "é 中 😀", "cr\r\nlf"]


def test_jsonl_round_trip(spark, tmp_path):
    rows = [(f"d{i % 2}/s.pdf", "s.pdf", i, t) for i, t in enumerate(TEXTS)] + [("d0/s.pdf", "s.pdf", 99, " \n")]
    path = str(tmp_path / "chunks")
    write_chunks(spark.createDataFrame(rows, CHUNK), path)
    assert sorted((r["chunk_index"], r["text"]) for r in read_chunks(spark, path).collect()) == list(enumerate(TEXTS))
    # a re-run replaces its own sources and leaves the others
    write_chunks(spark.createDataFrame([("d0/s.pdf", "s.pdf", 0, "new")], CHUNK), path)
    texts = sorted(r["text"] for r in read_chunks(spark, path).collect())
    assert texts == sorted(["new"] + [t for i, t in enumerate(TEXTS) if i % 2])
    assert corrupt_lines(spark, path).isEmpty()


def test_foreign_jsonl_with_bad_lines(spark, tmp_path):
    lines = [
        json.dumps({"source_file": "a.pdf", "chunk_index": 0, "text": "ok"}), "", "{bad", "  ",
        json.dumps({"source_file": "a.pdf", "chunk_index": 1}),
        json.dumps({"source_file": "a.pdf", "chunk_index": 2, "text": "ok   too"}, ensure_ascii=False),
    ]
    put(str(tmp_path), "p/a.jsonl", "\n".join(lines).encode())
    put(str(tmp_path), "p/other.txt", b"{}")
    root = str(tmp_path / "p")
    assert sorted(r["chunk_index"] for r in read_chunks(spark, root, "*.jsonl").collect()) == [0, 2]
    assert sorted(r["line"] for r in corrupt_lines(spark, root, "*.jsonl").collect()) == sorted([lines[2], lines[4]])


def test_no_chunks(spark, tmp_path):
    put(str(tmp_path), "a.jsonl", b"\n")
    with pytest.raises(NoChunks):
        read_chunks(spark, str(tmp_path), "*.jsonl")
    assert read_chunks(spark, str(tmp_path), "*.jsonl", allow_empty=True).count() == 0


def test_run_layout_keeps_the_latest_run_of_each_source(spark, tmp_path):
    path = str(tmp_path / "runs")
    write_chunk_run(spark.createDataFrame([("a", "a", 0, "old"), ("a", "a", 1, "old"), ("b", "b", 0, "b")], CHUNK), path, "r1")
    write_chunk_run(spark.createDataFrame([("a", "a", 0, "new")], CHUNK), path, "r2")
    write_chunk_run(spark.createDataFrame([("a", "a", 0, "new")], CHUNK), path, "r2")
    got = sorted((r["source_key"], r["text"]) for r in read_chunk_runs(spark, path).collect())
    assert got == [("a", "new"), ("b", "b")]


def test_a_single_run_is_read_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "runs")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    write_chunk_run(spark.createDataFrame([("a", "a", 0, "old"), ("b", "b", 0, "b")], CHUNK), path, "r1")
    one = read_chunk_runs(spark, path)
    assert "Exchange" not in plan(one)
    assert sorted((r["source_key"], r["text"]) for r in one.collect()) == [("a", "old"), ("b", "b")]
    write_chunk_run(spark.createDataFrame([("a", "a", 0, "new")], CHUNK), path, "r2")
    two = read_chunk_runs(spark, path)
    assert two.columns == one.columns and "Join" in plan(two)
    assert sorted((r["source_key"], r["text"]) for r in two.collect()) == [("a", "new"), ("b", "b")]


def rows_of(spark, n, dim=2):
    df = spark.createDataFrame(
        [("f.pdf", i, f"t{i}", [float(i)] * dim) for i in range(n)],
        "source_file string, chunk_index long, text string, embedding array<double>",
    )
    return store.to_collection(df)


def test_collection_life_cycle(spark):
    config = CollectionConfig("docs_a", "lib_a", 2)
    assert not store.exists(spark, config) and store.find_database(spark, "docs_a") is None
    store.create_or_replace(rows_of(spark, 7), config)
    store.create_or_replace(rows_of(spark, 5), config)
    assert store.exists(spark, config) and store.collections(spark, "lib_a") == ["docs_a"]
    assert store.find_database(spark, "docs_a") == "lib_a"
    assert store.count_rows(spark, config).head()["row_count"] == 5
    store.append(rows_of(spark, 8).filter("chunk_index >= 5"), config)
    table = store.open_collection(spark, config)
    assert table.select("id").distinct().count() == 8
    assert dict(table.dtypes) == {
        "id": "bigint", "source_file": "string", "chunk_index": "bigint", "text": "string", "embedding": "array<float>",
    }
    assert [r["col_name"] for r in store.describe(spark, config).collect()][:5] == list(store.COLUMNS)
    sample = store.query(table, "chunk_index >= 2", ["source_file", "chunk_index", "text"], 3)
    assert [r["chunk_index"] for r in sample.collect()] == [2, 3, 4]
    assert "embedding" not in plan_of(store.query(table, "chunk_index >= 2", ["chunk_index"]))
    assert store.query(table, "", ["count(*)"]).head()[0] == 8
    assert store.load(spark, config).count() == 8
    store.drop(spark, config)
    assert not store.exists(spark, config)


def test_failed_write_keeps_the_old_collection(spark):
    config = CollectionConfig("docs_b", "lib_a", 2)
    store.create_or_replace(rows_of(spark, 3), config)
    with pytest.raises(Exception, match="expected dimension"):
        store.create_or_replace(store.require_dim(rows_of(spark, 4, 3), 2), config)
    assert store.open_collection(spark, config).count() == 3


def test_partitioned_layout_splits_a_hot_value(spark):
    config = CollectionConfig("docs_c", "lib_a", 2)
    df = rows_of(spark, 60).withColumn("cell_id", F.when(F.col("chunk_index") < 40, 7).when(F.col("chunk_index") < 59, 8))
    for _ in range(2):
        store.create_or_replace(df, config, "cell_id", rows_per_file=10)
    table = store.open_collection(spark, config)
    assert table.count() == 60 and table.select("id").distinct().count() == 60
    named = table.select("cell_id", F.input_file_name().alias("file"))
    files = {r["cell_id"]: r["n"] for r in named.groupBy("cell_id").agg(F.count_distinct("file").alias("n")).collect()}
    assert 2 <= files[7] <= 4 and files[8] <= 2 and files[None] == 1


def test_ids_do_not_depend_on_partitioning(spark):
    df = rows_of(spark, 20)
    first = {(r["chunk_index"], r["id"]) for r in df.repartition(3).collect()}
    assert first == {(r["chunk_index"], r["id"]) for r in df.repartition(5, F.rand()).collect()}


def test_scratch_folder():
    from types import SimpleNamespace

    from passagemill.session import scratch_path

    def session(setting, master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: setting),
            sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
        )

    shared = session("s3a://bucket/scratch/", "spark://host")
    assert scratch_path(shared, "x").startswith("s3a://bucket/scratch/passagemill/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    local = session(None, "local[2]")
    assert os.path.dirname(scratch_path(local, "a")) == os.path.dirname(scratch_path(local, "b"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch_path(session(None, "spark://host"), "x")


def test_files_from_rows(spark, tmp_path):
    from passagemill.sources.files import read_bytes, write_files

    rows = [(f"{i % 3}/f{i}.txt", None if i == 4 else f"é {i}") for i in range(20)]
    root = str(tmp_path / "out")
    for _ in range(2):  # again, the same files
        assert write_files(spark.createDataFrame(rows, "name string, content string").repartition(4), root) == 20
    found = {r.path.removeprefix(root + "/"): r.length for r in list_files(spark, root, ".txt").collect()}
    assert found == {n: len((t or "").encode()) for n, t in rows}
    assert read_bytes(f"{root}/1/f7.txt") == "é 7".encode()
    assert write_files(spark.createDataFrame([], "name string, content string"), str(tmp_path / "none")) == 0


def test_files_of_wide_rows_are_bounded_by_bytes(spark):
    """Few partition folders, long vectors: a task writes a bounded part of a folder, not up to a million rows of it."""
    wide = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda i: i.cast("float"))
    df = spark.range(1000).select("id", wide.alias("embedding"), F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("model"))
    laid = store.even_files(df, "model", 1_000_000, bytes_per_file=50_000)
    per_task = laid.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count_distinct("model").alias("models")).collect()
    assert sum(r["n"] for r in per_task) == 1000 and max(r["n"] for r in per_task) < 200
    assert all(r["models"] <= 1 for r in per_task)
    assert sorted(map(tuple, laid.select("id", "model").collect())) == sorted(map(tuple, df.select("id", "model").collect()))
    assert store.even_files(df.limit(0), "model", 10).count() == 0
