import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from passagemill.config import SearchConfig
from passagemill.operators import search
from passagemill.operators.ivf import (
    Centroids, assign_cells, probed_top_k, recall, seed_centroids, train_centroids,
)
from passagemill.operators.search import gather_hits, top_k, top_k_of

BLOCKS = dict(broadcast_bytes=0, block_rows=7, block_queries=3)


def brute(vectors, queries, k, allowed=None):
    out = []
    for qid, q in queries:
        if q is None or not np.any(q):
            continue
        scored = []
        for key, v in vectors:
            if v is None or not np.any(v) or (allowed and not allowed(qid, key)):
                continue
            a, b = np.asarray(q, float), np.asarray(v, float)
            scored.append((-(a @ b) / np.sqrt((a @ a) * (b @ b)), key))
        out += [(qid, i + 1, key) for i, (_, key) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def frame(spark, rows, key, n=4):
    return spark.createDataFrame(rows, f"{key} long, embedding array<float>").repartition(n)


def found(df):
    return sorted((r["qid"], r["rk"], r["vec_id"]) for r in df.collect())


@pytest.fixture(scope="module")
def data():
    # whole numbers: many exact ties, copies, a zero vector and a null
    rng = np.random.default_rng(3)
    vectors = [(i, rng.integers(-1, 2, 4).astype(float).tolist()) for i in range(60)]
    vectors += [(100 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(30)]  # a third are copies
    vectors += [(200, [0.0] * 4), (201, None)]
    queries = [(i, rng.integers(-1, 2, 4).astype(float).tolist()) for i in range(9)]
    queries += [(50, [0.0] * 4), (51, None), (52, [1.0, 0.0, 0.0, 0.0])]
    return vectors, queries


@pytest.mark.parametrize("k", [1, 5, 1000])  # 1000 takes the two-step ranking
@pytest.mark.parametrize("path", [{}, BLOCKS])
def test_exact_search_with_ties(spark, data, k, path):
    vectors, queries = data
    got = top_k(frame(spark, vectors, "vec_id"), frame(spark, queries, "qid"), ["vec_id"], config=SearchConfig(k=k, **path))
    assert found(got) == brute(vectors, queries, k)


def test_small_arrow_batches_change_nothing(spark, data):
    vectors, queries = data
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        for path in ({}, BLOCKS):
            got = top_k(frame(spark, vectors, "vec_id"), frame(spark, queries, "qid"), ["vec_id"], config=SearchConfig(**path))
            assert found(got) == brute(vectors, queries, 5)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_single_query_and_string_keys(spark):
    df = spark.createDataFrame(
        [("b", 0, [1.0, 0.0]), ("a", 1, [1.0, 0.0]), ("a", 0, [0.0, 1.0])],
        "source_file string, chunk_index long, embedding array<float>",
    )
    got = top_k_of(df, [2.0, 0.0], ["source_file", "chunk_index"], k=2).collect()
    assert [(r["source_file"], r["chunk_index"], r["score"]) for r in got] == [("a", 1, 1.0), ("b", 0, 1.0)]


def test_empty_sides(spark, data):
    vectors, queries = data
    v, q = frame(spark, vectors, "vec_id"), frame(spark, queries, "qid")
    assert top_k(v.limit(0), q, ["vec_id"]).count() == 0
    assert top_k(v, q.limit(0), ["vec_id"]).count() == 0
    gathered = gather_hits(q.select("qid"), top_k(v.limit(0), q, ["vec_id"]))
    assert gathered.count() == len(queries) and gathered.filter(F.size("hits") > 0).count() == 0


def test_dimension_mismatch_is_an_error(spark):
    v = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0])], "qid long, embedding array<float>")
    with pytest.raises(Exception, match="dimension"):
        top_k(v, q, ["vec_id"]).collect()


@pytest.mark.parametrize("path", [{}, dict(broadcast_bytes=0, block_rows=4, block_queries=2)])
def test_probed_search(spark, data, path):
    vectors, queries = data
    v, q = frame(spark, vectors, "vec_id"), frame(spark, queries, "qid")
    centroids = Centroids(seed_centroids(v, "vec_id", 6))
    indexed = assign_cells(v, centroids)
    cells = {r["vec_id"]: r["cell_id"] for r in indexed.collect()}
    assert cells[200] is None and cells[201] is None
    assert all(c is not None for i, c in cells.items() if i < 200 and np.any(dict(vectors)[i]))
    full = probed_top_k(indexed, q, centroids, ["vec_id"], config=SearchConfig(nprobe=99, **path))
    assert found(full) == brute(vectors, queries, 5)
    probes = {
        qid: set(centroids.probes(np.asarray([vec]), 2)[0].tolist()) for qid, vec in queries if vec and np.any(vec)
    }
    some = probed_top_k(indexed, q, centroids, ["vec_id"], config=SearchConfig(nprobe=2, **path))
    assert found(some) == brute(vectors, queries, 5, lambda qid, key: cells[key] in probes[qid])


def test_trained_index_and_recall(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    q = v.withColumnRenamed("vec_id", "qid")
    centroids = Centroids(train_centroids(v, 8))
    indexed = assign_cells(v, centroids)
    assert indexed.filter("cell_id is null").count() == 0
    exact = top_k(v, q, ["vec_id"])
    full = probed_top_k(indexed, q, centroids, ["vec_id"], config=SearchConfig(nprobe=8))
    assert recall(exact, full, ["vec_id"]).head()["recall"] == 1.0
    some = recall(exact, probed_top_k(indexed, q, centroids, ["vec_id"], config=SearchConfig(nprobe=2)), ["vec_id"]).head()
    assert 0 < some["recall"] < 1 and some["expected"] == 2500


def test_too_large_centroids_are_refused(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    with pytest.raises(ValueError, match="assign_cells_of"):
        Centroids(seed_centroids(v, "vec_id", 50), limit_bytes=1000)


def test_search_plan(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = v.select(F.col("vec_id").alias("qid"), "embedding")
    plan = plan_of(top_k(v, q, ["vec_id"]))
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan
    # the collection itself is not shuffled: one exchange, above the per-task winners
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("MapInArrow")


def test_probed_search_reads_only_probed_cells(spark, data, tmp_path):
    vectors, _ = data
    v = frame(spark, vectors, "vec_id")
    centroids = Centroids(seed_centroids(v, "vec_id", 6))
    assign_cells(v, centroids).write.partitionBy("cell_id").parquet(f"{tmp_path}/c")
    stored = spark.read.parquet(f"{tmp_path}/c")
    q = spark.createDataFrame([(1, [1.0, 1.0, 0.0, 0.0])], "qid long, embedding array<float>")
    plan = plan_of(probed_top_k(stored, q, centroids, ["vec_id"], config=SearchConfig(nprobe=2)))
    assert "PartitionFilters: [cell_id" in plan


def test_what_travels_grows_with_the_input():
    """Of ten times the rows, as often as before each vector and query: small blocks made that grow with the square (F1)."""
    small = SearchConfig(block_rows=200, block_queries=300)
    sizes = [search._grid([(0, n)], n, 64, True, 12, small) for n in (10_000, 100_000, 600_000)]
    assert {(g.blocks, g.turns) for g in sizes} == {(7, 7)}
    huge = search._grid([(0, 10_000_000)], 10, 64, True, 12, small)  # memory asks for more blocks
    assert huge.blocks * search.BLOCK_BYTES >= 10_000_000 * 64 * 8 and huge.turns == 1


def test_cells_share_blocks_and_hot_ones_are_split():
    cells = [(c, 10) for c in range(90)] + [(90, 5000)]
    g = search._grid(cells, 50, 4, True, 8, SearchConfig(block_rows=1000))
    assert g.blocks == 6 and g.parts[-1] >= 5 and g.parts[:80].max() == 1
    alone = search._grid([("a", 10), ("b", 5000)], 50, 4, False, 8, SearchConfig(block_rows=1000))
    assert alone.first.tolist() == [0, 1] and alone.parts.tolist() == [1, 6]
    lists = search.blocks_of(pa.array([[3, 90], None, [1000], [5, 4]], pa.list_(pa.int32())), g.cells, g.first, g.parts).to_pylist()
    assert [(x["block"], x["cells"]) for x in lists[0]][0][1][0] == 3 and len(lists[0]) >= g.parts[-1]
    assert lists[1:3] == [[], []] and lists[3] == [{"block": 0, "cells": [4, 5]}]


@pytest.mark.parametrize("listed", [False, True])
def test_block_of_rising_scores(listed):
    """Every slab beats the one before; ties go to the smaller key."""
    rng = np.random.default_rng(5)
    angles = np.sort(rng.random(5000))[::-1].repeat(2)
    vectors = np.stack([np.cos(angles), np.sin(angles)], axis=1).astype(np.float32)
    keys = rng.permutation(len(angles))
    cell = np.arange(len(angles)) // 2500
    table = pa.table({"id": keys, "__v": pa.array(vectors.tolist(), pa.list_(pa.float32())), "__no": cell})
    held = search.HeldBlock(table, "__v", ["id"], "__no")
    asked = [[1.0, 0.0], [0.0, 0.0], [0.5, 0.5]]
    lists = pa.array([[1, 3], [0], [0, 2]], pa.list_(pa.int32())) if listed else None
    got = {}
    for names, rows, scores in held.search(pa.array([7, 8, 9]), pa.array(asked, pa.list_(pa.float32())), lists, 5):
        for n, i, s in zip(names.to_pylist(), rows.column("id").to_pylist(), scores):
            got.setdefault(n, []).append((-s, i))
    allowed = {7: [1, 3], 9: [0, 2]}
    for n, q in ((7, asked[0]), (9, asked[2])):
        want = brute([(int(k), v) for k, v, c in zip(keys, vectors, cell) if not listed or c in allowed[n]], [(n, q)], 5)
        assert [i for _, i in sorted(got[n])] == [i for _, _, i in want]
    assert 8 not in got


def test_shipped_search_takes_few_vectors_at_a_time(monkeypatch):
    """An Arrow batch of long vectors is widened slice by slice."""
    rng = np.random.default_rng(5)
    vectors = rng.integers(-1, 2, (1000, 8)).astype(np.float32)
    batch = pa.record_batch({"key": pa.array(range(1000)), "v": pa.array(vectors.tolist(), pa.list_(pa.float32()))})
    block = search.QueryBlock.of(pa.array([1, 2]), pa.array(rng.integers(1, 3, (2, 8)).astype(float).tolist(), pa.list_(pa.float64())))
    whole = search.BestK(block, 5, ["key"])
    whole.add(batch, "v")

    seen, add = [], search.BestK.add_prepared
    monkeypatch.setattr(search, "_SCAN_VALUES", 800)
    monkeypatch.setattr(search.BestK, "add_prepared", lambda self, rows: (seen.append(rows[1].size), add(self, rows))[1])
    sliced = search.BestK(block, 5, ["key"])
    sliced.add(batch, "v")
    assert sliced.best.equals(whole.best) and max(seen) <= 800


def test_training_partitions_are_bounded_by_bytes(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans
    from passagemill.operators import ivf

    rng = np.random.default_rng(9)
    table = frame(spark, [(i, rng.normal(size=16).tolist()) for i in range(2000)], "vec_id")
    seen, fit = [], KMeans.fit

    def counted(self, points):
        seen.extend(r["n"] for r in points.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        return fit(self, points)

    monkeypatch.setattr(KMeans, "fit", counted)
    monkeypatch.setattr(ivf, "TRAINING_BYTES", 100 * 16 * 8)
    cells = train_centroids(table, 4, iterations=1)
    assert cells.count() == 4 and sum(seen) == 2000 and max(seen) <= 200
    with pytest.raises(Exception):  # nothing to train on
        train_centroids(table.limit(0), 4)
