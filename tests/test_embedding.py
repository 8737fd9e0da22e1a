import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagemill.functions.vectors import l2_normalize
from passagemill.operators import embedding
from passagemill.operators.embedding import (
    EndpointEmbedder, LocalEmbedder, choose_embedder, embed, hashed_vectors, http_json_client, vectors_of_reply,
)
from passagemill.plans.ingest import collection_rows, split_by_dim
from passagemill.config import CollectionConfig

TEXTS = ["The cat sat on the CAT", "", "Élan vital", "the"]


def hashed(text, dim):
    v = [0] * dim
    for t in text.lower().split():
        h = int(hashlib.md5(t.encode()).hexdigest()[:8], 16)
        v[h % dim] += 1 if (h // dim) % 2 == 0 else -1
    return v


def test_feature_hashing(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(4, None)], "i long, text string")
    got = [r[1] for r in df.select("i", hashed_vectors(F.col("text"), 16).alias("v")).orderBy("i").collect()]
    assert got == [hashed(t, 16) for t in TEXTS] + [None]  # a missing text has no vector
    unit = [r[1] for r in df.select("i", hashed_vectors(F.col("text"), 16, True).alias("v")).orderBy("i").collect()]
    assert unit.pop() is None and np.allclose(np.linalg.norm(unit, axis=1), [1, 0, 1, 1])


def test_local_embedder_brings_rows_to_unit_length(spark):
    encoder = LocalEmbedder(lambda: lambda texts: [[len(t), 1.0] for t in texts])
    df = embed(spark.createDataFrame([("abc",)], "text string"), encoder)
    assert np.allclose(df.head()["embedding"], np.array([3, 1]) / np.sqrt(10))


def test_endpoint_replies_are_put_in_order(spark):
    def make_client():
        def post(payload):
            assert len(payload["input"]) <= 3 and payload["model"] == "m"
            data = [{"index": i, "embedding": [float(len(t)), 2.0]} for i, t in enumerate(payload["input"])]
            return {"data": data[::-1]}

        return post

    texts = ["a" * n for n in range(1, 21)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = embed(df, EndpointEmbedder(make_client, "m", 3)).collect()
    assert all(r["embedding"] == [len(r["text"]), 2.0] for r in rows)


def test_endpoint_failures_fail_the_job(spark):
    def broken():
        def post(payload):
            raise OSError("503")

        return post

    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(Exception, match="503"):
        embed(df, EndpointEmbedder(broken, "m")).collect()
    with pytest.raises(Exception, match="asked for 1 vectors"):
        embed(df, EndpointEmbedder(lambda: lambda p: {"data": []}, "m")).collect()


def test_mode_switch():
    assert isinstance(choose_embedder("http://host", "m"), EndpointEmbedder)
    assert isinstance(choose_embedder("", "m", lambda: None), LocalEmbedder)
    with pytest.raises(ValueError):
        choose_embedder("", "m")


def test_http_client_builds_the_request(monkeypatch):
    import io
    import urllib.request

    seen = {}

    def fake(request, timeout):
        seen.update(url=request.full_url, body=request.data, timeout=timeout, method=request.get_method())
        return io.BytesIO(b'{"data": []}')

    monkeypatch.setattr(urllib.request, "urlopen", fake)
    assert http_json_client("http://host/v1/embeddings", 5)({"input": []}) == {"data": []}
    assert seen == {"url": "http://host/v1/embeddings", "body": b'{"input": []}', "timeout": 5, "method": "POST"}


def test_stored_reply(spark):
    reply = '{"data":[{"embedding":[2.0],"index":2},{"embedding":[0.0],"index":0},{"embedding":[1.0],"index":1}]}'
    df = spark.createDataFrame([(reply,)], "r string")
    assert df.select(vectors_of_reply(F.col("r"))).head()[0] == [[0.0], [1.0], [2.0]]


def test_l2_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(l2_normalize(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_wrong_dimension_fails_or_is_set_aside(spark):
    encoder = LocalEmbedder(lambda: lambda texts: [[1.0] * (4 if len(t) > 1 else 3) for t in texts[:1]] or [])
    config = CollectionConfig(dim=4)
    chunks = spark.createDataFrame([("f", 0, "a")], "source_file string, chunk_index long, text string")
    rows, _ = collection_rows(chunks, config, encoder)
    with pytest.raises(Exception, match="expected dimension 4, got 3"):
        rows.collect()
    mixed = spark.createDataFrame([(1, [1.0] * 4), (2, [1.0] * 3)], "id long, embedding array<float>")
    good, bad = split_by_dim(mixed, 4)
    assert [r["id"] for r in good.collect()] == [1]
    assert [r["id"] for r in bad.collect()] == [2]


def test_long_texts_are_set_aside(spark):
    config = CollectionConfig(max_text_bytes=32768)
    chunks = spark.createDataFrame(
        [("f", 0, "x" * 32768), ("f", 1, "x" * 32769), ("f", 2, "é" * 16385), ("g" * 600, 0, "a")],
        "source_file string, chunk_index long, text string",
    )
    rows, rejected = collection_rows(chunks, config)
    assert [r["chunk_index"] for r in rows.collect()] == [0]
    assert sorted((r["chunk_index"], r["problem"]) for r in rejected.collect()) == [
        (0, "source_file too long"), (1, "text too long"), (2, "text too long"),
    ]


def test_long_texts_are_hashed_few_at_a_time(spark, monkeypatch):
    """A task's memory follows neither the words of an Arrow batch nor all the words it ever saw."""
    texts = [" ".join(f"w{i * j % 97}" for j in range(i % 40)) for i in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    whole = {r["id"]: r["v"] for r in rows.select("id", embedding.hashed_vectors(F.col("text"), 16).alias("v")).collect()}

    monkeypatch.setattr(embedding, "_TOKENS_AT_ONCE", 50)
    monkeypatch.setattr(embedding, "_KNOWN_TOKENS", 10)
    got = {r["id"]: r["v"] for r in rows.select("id", embedding.hashed_vectors(F.col("text"), 16).alias("v")).collect()}
    assert got == whole

    lengths = np.array([len(t.split()) for t in texts])
    parts = list(embedding._slices(lengths, 7, 50))
    assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == 300
    assert all(b - a <= 7 and (lengths[a:b].sum() <= 50 or b == a + 1) for a, b in parts)
    assert list(embedding._slices(np.array([900, 0, 0, 900]), 7, 50)) == [(0, 1), (1, 3), (3, 4)]
