import math
import re
from collections import Counter

import numpy as np
import pytest
from check import compare, oracle_connection
from conftest import SF
from llm_rows import odd  # noqa: F401

from passagemill.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")))


def brute(docs, items, k):
    """Sorted (item, rank, doc, score) by scoring every document for every item."""
    docs = [(i, Counter(words(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        scores = []
        for i, c, n in docs:
            m = 100 - 25 + ((25 * n * n_docs) // n_terms)
            scores.append((-sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if t in c), i is None, i or 0, i))
        best = sorted((s for s in scores if s[0] < 0), key=lambda s: s[:3])[:k]
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(best)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


ITEMS = [
    (1, "alpha Beta gamma, one two three"), (2, "word word one"), (3, None), (4, ""), (5, " ... "), (6, "unseen terms only"),
    (7, "no id here éa 漢字 s 3 5"), (None, "one"), (1, "alpha"), (8, "alpha Beta gamma, one two three"),
]


@pytest.fixture()
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.mark.parametrize("k", [1, 3, 20])
def test_odd_rows(odd, items, k):
    df = odd("rank")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(lexical.search(df, items, k)) == brute(rows, ITEMS, k)


@pytest.mark.parametrize(("bucket", "seeds", "block"), [(1, 1, 1 << 20), (7, 5, 100), (2048, 4096, 2000)])
def test_buckets_seeds_and_blocks_change_nothing(spark, sf, monkeypatch, bucket, seeds, block):
    monkeypatch.setattr(lexical, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(lexical, "SEED_ROWS", seeds)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    copies = docs.union(docs.where("doc_id < 5").selectExpr("doc_id + 100000 as doc_id", "text"))
    items = spark.read.parquet(f"{sf}/benchmark.parquet").where("item_id < 12")
    rows = [(r.doc_id, r.text) for r in copies.collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert found(lexical.search(copies, items, 5, block_bytes=block)) == brute(rows, asked, 5)


def test_ties_go_by_id_in_and_across_tasks(spark):
    rows = [(i, "same words here" if i % 3 else f"other text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    items = spark.createDataFrame([(1, "same"), (2, "words words text")], "item_id bigint, text string")
    assert found(lexical.search(docs, items, 20)) == brute(rows, [(1, "same"), (2, "words words text")], 20)


def test_empty_tables(spark, items):
    docs = spark.createDataFrame([(1, "one two")], "doc_id bigint, text string")
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.selectExpr("doc_id", "cast(null as string) as text"), items).collect() == []


def _vectors(rng, n, v):
    rows = [np.flatnonzero(rng.random(v) < 0.3).astype(np.int32) for _ in range(n)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return np.concatenate(rows), starts


def test_bounds_pass_buckets_over_and_lose_nothing():
    rng = np.random.default_rng(3)
    import pyarrow as pa

    weights = rng.integers(1, 9000, 40)
    term, starts = _vectors(rng, 400, 40)
    impact = rng.integers(1, 900_000, len(term)).astype(np.int64)
    row = np.repeat(np.arange(400), np.diff(starts))
    length = np.sqrt(np.bincount(row, weights[term] * impact.astype(float) ** 2, 400))
    block = lexical.Items([b" ".join(b"t%d" % t for t in rng.choice(40, 5)) for _ in range(20)])
    block.counts = [(rng.choice(40, 5, replace=False), rng.integers(1, 3, 5)) for _ in range(20)]
    items = block.weighted(weights)
    dense = np.zeros((400, 40), np.int64)
    dense[row, term] = impact
    truth = [dense[:, t] @ (weights[t] * r) for t, r in block.counts]
    best = [lexical.Best(5, 0) for _ in items]
    looked = scored = 0
    order = np.argsort(-length)
    for at in range(0, 400, 20):
        some = order[at : at + 20]
        pick = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in some])
        ends = np.concatenate([[0], np.cumsum(starts[some + 1] - starts[some])])
        a, s = lexical.search_bucket(items, best, length[some], term[pick], impact[pick], ends, pa.array(some), weights, np.zeros(40, np.int64))
        looked, scored = looked + a, scored + s
    assert scored < 20 * 400 * 0.7  # many are left out by the bounds
    for b, t in zip(best, truth):
        want = sorted(((-int(t[i]), int(i)) for i in range(400) if t[i] > 0))[:5]
        assert [(r[0], r[2]) for r in b.rows] == want


def test_a_bucket_out_of_reach_is_passed_over():
    import pyarrow as pa

    items = lexical.Items([b"a b"]).weighted(np.array([4, 9]))
    args = (np.array([10.0]), np.array([0], np.int32), np.array([5], np.int64), np.array([0, 1]), pa.array([1]), np.array([4, 9]), np.zeros(2, np.int64))
    assert lexical.search_bucket(items, [lexical.Best(1, 1000)], *args) == (0, 0)
    assert lexical.search_bucket(items, [lexical.Best(1, 30)], *args)[0] == 1


def test_registered_query(spark):
    verdict, _, _ = compare(spark, oracle_connection(SF), SF, "op13_lexical_search")
    assert verdict.startswith("ok"), verdict
