import random
import sys
import threading
import time

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from passagemill.operators import packing
from passagemill.operators.embedding import PipelinedEndpoint, embed, embed_or_error
from passagemill.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def files(spark, lengths, parts=5):
    rows = [(f"f{i:05d}", n) for i, n in enumerate(lengths)]
    return materialise(packing.with_cost(spark.createDataFrame(rows, "source_key string, length long").repartition(parts)), "files")


def loads(packed, tasks):
    got = {r.task: r.cost for r in packed.groupBy("task").agg(F.sum("cost").alias("cost")).collect()}
    assert all(0 <= t < tasks for t in got)
    return [got.get(t, 0.0) for t in range(tasks)]


def test_skewed_sizes_give_even_tasks(spark):
    rng = random.Random(3)
    lengths = [int(rng.lognormvariate(13, 1.6)) for _ in range(4000)]
    packed = packing.pack(files(spark, lengths), 20)
    got = loads(packed, 20)
    assert max(got) <= 1.2 * sum(got) / 20 and packed.count() == 4000
    # dealt round, as by count alone, the greatest task would be further off
    by_count = np.bincount(np.arange(4000) % 20, lengths)
    assert max(got) / np.mean(got) < by_count.max() / by_count.mean()


def test_each_task_in_a_partition_of_its_own(spark):
    packed = packing.pack(files(spark, [100_000 * (i % 13) for i in range(300)]), 11)
    rows = packing.placed(packed, 11).withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.collect_set("task").alias("t")).collect()
    assert len(rows) == 11 and all(len(r.t) == 1 for r in rows)


def test_ranges_change_nothing(spark, monkeypatch):
    lengths = [(i * 7919) % 5000 for i in range(500)] + [0] * 40 + [2_000_000]
    want = {r.source_key: r.task for r in packing.pack(files(spark, lengths), 7).collect()}
    monkeypatch.setattr(packing, "_RANGE_ROWS", 20)
    assert {r.source_key: r.task for r in packing.pack(files(spark, lengths, 2), 7).collect()} == want


def test_times_of_the_last_run(spark):
    listed = spark.createDataFrame([("a", 1000), ("b", 1000), ("c", 500_000), ("d", None)], "source_key string, length long")
    log = spark.createDataFrame([("a", 90.0), ("a", 100.0), ("b", 1.0), ("x", 5.0), ("c", None)], "source_key string, duration_s double")
    cost = {r.source_key: r.cost for r in packing.with_cost(listed, log).collect()}
    rate = 101.0 / (2 * (1000 + packing.FILE_BYTES))
    assert cost["a"] == 100.0 and cost["b"] == 1.0
    assert cost["c"] == pytest.approx(rate * (500_000 + packing.FILE_BYTES)) and cost["d"] == pytest.approx(rate * packing.FILE_BYTES)
    nothing = {r.source_key: r.cost for r in packing.with_cost(listed, log.limit(0)).collect()}
    assert nothing["a"] == 1000 + packing.FILE_BYTES


def test_no_files_one_file_equal_files(spark):
    assert packing.pack(files(spark, []), 4).collect() == []
    assert [r.task for r in packing.pack(files(spark, [5]), 4).collect()][0] in range(4)
    assert max(loads(packing.pack(files(spark, [10] * 100), 10), 10)) == 10 * (10 + packing.FILE_BYTES)


# ---- the endpoint -------------------------------------------------------------------------


class Wrong(Exception):
    code = 400


class Busy(Exception):
    code = 503


def service(delay=0.0, busy=0, seen=None):
    """Length of each text, doubled; the first ``busy`` tries of each sub-batch fail, and texts with an x for good."""
    tries, lock = {}, threading.Lock()

    def post(payload):
        key = tuple(payload["input"])
        with lock:
            tries[key] = tries.get(key, 0) + 1
            n = tries[key]
        if delay:
            time.sleep(delay * (1 + len(key[0]) % 3))
        if n <= busy:
            raise Busy("try later")
        if any("x" in t for t in key):
            raise Wrong("no x")
        return {"data": [{"index": i, "embedding": [float(len(t)), 2.0 * len(t)]} for i, t in reversed(list(enumerate(key)))]}

    return post


def rows(spark, n=100):
    texts = [(i, None if i % 17 == 5 else "x" if i % 23 == 7 else "a" * (i % 31)) for i in range(n)]
    return texts, spark.createDataFrame(texts, "i int, text string").repartition(3)


@pytest.mark.parametrize(("busy", "window", "sub"), [(0, 1, 1), (2, 4, 1), (1, 8, 3)])
def test_vectors_errors_and_attempts(spark, busy, window, sub):
    texts, df = rows(spark)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = {r.i: r for r in embed_or_error(df, PipelinedEndpoint(lambda: service(0.001, busy), "m", sub, window, 4, 0.001)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == 100
    for i, t in texts:
        r = got[i]
        if t is None:
            assert r.embedding is None and r.error is None and r.attempts == 0
        elif r.error is None:
            assert list(r.embedding) == [len(t), 2 * len(t)] and 1 <= r.attempts <= busy + 1
        else:
            assert r.error == "Wrong: no x" and r.embedding is None and (t == "x" or sub > 1)
    if sub == 1:
        assert {i for i, r in got.items() if r.error} == {i for i, t in texts if t == "x"}


def test_same_vectors_as_one_after_another(spark):
    _, df = rows(spark)
    df = df.where("text not like '%x%'")
    from passagemill.operators.embedding import EndpointEmbedder

    one = {r.i: list(r.embedding) for r in embed(df, EndpointEmbedder(lambda: service(), "m", 5)).collect()}
    many = {r.i: list(r.embedding) for r in embed_or_error(df, PipelinedEndpoint(lambda: service(0.002), "m", 5, 6)).collect()}
    assert one == many


def test_a_service_that_stays_busy_is_given_up(spark):
    _, df = rows(spark, 5)
    got = embed_or_error(df, PipelinedEndpoint(lambda: service(busy=99), "m", 1, 2, 3, 0.001)).where("text is not null").collect()
    assert all(r.error == "Busy: try later" and r.attempts == 3 for r in got)


def test_requests_overlap():
    """Twelve requests of 50 ms, four at a time, in one task."""
    under, most, lock = [0], [0], threading.Lock()

    def make():
        def post(payload):
            with lock:
                under[0] += 1
                most[0] = max(most[0], under[0])
            time.sleep(0.05)
            with lock:
                under[0] -= 1
            return {"data": [{"index": 0, "embedding": [1.0]}]}

        return post

    from concurrent.futures import ThreadPoolExecutor

    one = PipelinedEndpoint(make, "m", 1, 4).load_one()
    began = time.monotonic()
    with ThreadPoolExecutor(4) as pool:
        assert all(e is None for _, e, _ in pool.map(one, [["a"]] * 12))
    assert time.monotonic() - began < 0.4 and most[0] == 4
