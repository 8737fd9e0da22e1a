import zlib
from collections import Counter

import __spark_entry__ as contract
from conftest import SF, plan_of

from llm_rows import odd  # noqa: F401

from passagemill.llm import sharding


def check(rows, n):
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r.slot)
    counts = [len(shards.get(s, [])) for s in range(8)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())


def test_query(spark, sf):
    rows = contract.queries()["op3_sharding"](spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    check(rows, len(docs))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (r.doc_id, len(r.text.encode()) + 1, zlib.crc32(r.text.encode())) for r in docs
    )
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    again = contract.queries()["op3_sharding"](spark, SF).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_uniform(spark, tmp_path):
    """Over many seeds, every row comes to every place about as often."""
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, str(i)) for i in range(6)], "doc_id bigint, text string").coalesce(1).write.parquet(path)
    docs, first = spark.read.parquet(path), Counter()
    for seed in range(40):
        rows = sharding.shard(docs, shards=2, seed=seed).collect()
        first.update(r.doc_id for r in rows if (r.shard, r.slot) == (0, 0))
    assert len(first) == 6 and max(first.values()) <= 20


def test_awkward_rows(spark, odd):
    docs = odd("slot")
    found = sharding.shard(docs, bucket_bytes=1000)
    rows = found.collect()
    check(rows, 12)
    assert found.columns.count("slot") == 1
    key = lambda r: (r.doc_id, r.text, r.lang, r.source, r.other)
    assert Counter(map(key, rows)) == Counter(map(key, docs.collect()))
    assert sharding.shard(odd("slot", rows=[])).count() == 0
    assert "Python" not in plan_of(found) and "Arrow" not in plan_of(found)


def test_write(spark, odd, tmp_path):
    out = str(tmp_path / "shards")
    sharding.write_shards(sharding.shard(odd("size")), out)
    back = spark.read.parquet(out)
    assert back.count() == 12 and back.select("shard").distinct().count() == 8
