import time
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagemill.operators import progress, reports

LOG = "source_file string, status string, page_count long, chunk_count long, error string, duration_s double, actor_host string"


@pytest.fixture()
def log(spark):
    rows = [
        (f"f{i}", ("success", "empty", "error", "timeout")[i % 7 % 4], i % 5, i % 3, "", 0.25 * (i % 11), f"h{i % 3}") for i in range(300)
    ]
    return spark.createDataFrame(rows, LOG).repartition(5)


def test_report_of_the_write_itself(spark, log, tmp_path):
    run, taken = progress.observed(log)
    run.write.parquet(str(tmp_path / "out"))
    got = progress.observed_report(spark, taken)
    want = reports.run_report(spark.read.parquet(str(tmp_path / "out")))
    assert got.columns == want.columns and got.collect() == want.collect()
    # the plan reads the log once
    plan = run._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectMetrics") == 1 and plan.count("Scan ") == 1


def test_report_of_an_empty_run(spark, log, tmp_path):
    run, taken = progress.observed(log.limit(0))
    run.write.parquet(str(tmp_path / "out"))
    row = progress.observed_report(spark, taken).first()
    assert row.total_files == row.total_chunks == 0 and row.avg_duration_s is None


def test_progress_while_a_batch_runs(spark):
    def slow(batches):
        for b in batches:
            time.sleep(0.3)
            yield b

    shown = []
    with progress.BatchProgress(spark, 0.1, shown.append) as watched:
        spark.range(0, 40, 1, 40).mapInArrow(slow, "id long").write.format("noop").mode("overwrite").save()
    ticks = watched.ticks
    assert shown == ticks and ticks[-1].done == ticks[-1].total == 40
    middle = [t for t in ticks if 0 < t.done < t.total]
    assert middle and all(t.eta_s > 0 for t in middle) and all(a.done <= b.done for a, b in zip(ticks, ticks[1:]))
    assert "tasks" in progress.progress_line(middle[0]) and progress.Tick(1.0, 0, 5).eta_s is None
    # other jobs are not watched
    spark.range(10).count()
    assert watched.ticks == ticks and spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_sketches_merge_into_any_window(spark):
    rng = np.random.default_rng(4)
    rows = [(datetime(2024, 1, 1 + i % 20), f"h{i % 2}", float(x)) for i, x in enumerate(rng.gamma(2.0, 3.0, 20_000))] + [(datetime(2024, 1, 1), "h0", None)]
    log = spark.createDataFrame(rows, "finished_at timestamp, actor_host string, duration_s double").withColumn("day", F.to_date("finished_at"))
    sketches = progress.duration_sketches(log, ["actor_host", "day"]).cache()
    for where in ("day < '2024-01-08'", "day >= '2024-01-08'", "true"):
        for r in progress.merged_quantiles(sketches.where(where), ["actor_host"]).collect():
            values = np.sort([x[2] for x in log.where(where).where(f"actor_host = '{r.actor_host}'").select("finished_at", "actor_host", "duration_s").collect() if x[2] is not None])
            assert r.n == len(values)
            for q, got in ((0.5, r.p50), (0.95, r.p95)):
                assert abs(np.searchsorted(values, got) / len(values) - q) < 0.015
    assert progress.merged_quantiles(sketches.limit(0), ["actor_host"]).collect() == []
    assert progress.merged_quantiles(sketches, []).first().n == 20_000
