import datetime as dt
import random

from passagemill.operators import reports

LOG = "source_file string, status string, page_count int, chunk_count long, error string, duration_s double, actor_host string, finished_at timestamp"


def log(spark, rows):
    return spark.createDataFrame(rows, LOG)


def row(name, status, pages=0, chunks=0, error="", second=0, host="h0", duration=1.0):
    return (name, status, pages, chunks, error, duration, host, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second))


def test_report_counts_unknown_status_as_error(spark):
    rows = [row("a", "success", 2, 5), row("b", "empty", 1), row("c", "weird"), row("d", "timeout"), row("e", "error")]
    r = reports.run_report(log(spark, rows)).head().asDict()
    assert r == {
        "total_files": 5, "success": 1, "empty": 1, "errors": 2, "timeouts": 1, "total_pages": 3, "total_chunks": 5,
        "avg_duration_s": 1.0,
    }


def test_reports_of_nothing(spark):
    nothing = log(spark, [])
    assert reports.run_report(nothing).head()["total_files"] == 0
    assert reports.worker_distribution(nothing).count() == 0
    assert reports.throughput(nothing).head()["files_per_second"] is None
    assert reports.progress(nothing).count() == 0
    assert reports.first_errors(nothing).count() == 0


def test_zero_wall_clock(spark):
    r = reports.throughput(log(spark, [row("a", "success", 1, 1)])).head()
    assert r["wall_clock_s"] == 0.0 and r["files_per_second"] is None and r["chunks_per_second"] is None
    assert reports.throughput(log(spark, [row("a", "success", 1, 4)]), wall_clock_s=2.0).head()["chunks_per_second"] == 2.0


def test_errors_are_cut_and_limited(spark):
    rows = [row(f"f{i:02d}", "error", error="e" * 500) for i in range(12)] + [row("a", "empty", error="none")]
    got = reports.first_errors(reports.normalise_log(log(spark, rows))).collect()
    assert [r["source_file"] for r in got] == [f"f{i:02d}" for i in range(10)]
    assert all(r["error"] == "e" * 80 for r in got)
    assert reports.normalise_log(log(spark, rows)).filter("length(error) > 200").count() == 0


def test_normalised_log_zeroes_failed_rows(spark):
    rows = [row("a", "timeout", 4, 4), row("b", "empty", 3, 9), row("c", "odd", 1, 1)]
    got = {r["source_file"]: (r["status"], r["page_count"], r["chunk_count"]) for r in reports.normalise_log(log(spark, rows)).collect()}
    assert got == {"a": ("timeout", 0, 0), "b": ("empty", 3, 0), "c": ("error", 0, 0)}


def test_worker_percentages(spark):
    rows = [row(str(i), "success", host=f"h{i % 3}") for i in range(4)]
    got = [(r["actor_host"], r["files"], r["pct"]) for r in reports.worker_distribution(log(spark, rows)).collect()]
    assert got == [("h0", 2, 50.0), ("h1", 1, 25.0), ("h2", 1, 25.0)]


def test_progress_against_brute_force(spark):
    rng = random.Random(5)
    seconds = sorted(rng.choice([rng.randint(0, 400), rng.randint(300_000, 300_100)]) for _ in range(200))
    got = sorted(reports.progress(log(spark, [row(str(i), "success", second=s) for i, s in enumerate(seconds)])).collect())
    want, first = [], seconds[0] // 30
    for tick in sorted({s // 30 for s in seconds}):
        done = sum(1 for s in seconds if s // 30 <= tick)
        elapsed = (tick - first + 1) * 30
        want.append((elapsed, done, round(done * 100 / 200, 6), round(done / elapsed, 6), round((200 - done) / (done / elapsed) / 60, 3)))
    assert [tuple(r) for r in got] == want
    assert got[-1]["processed"] == 200 and got[-1]["eta_min"] == 0


def test_reconcile(spark):
    expected = spark.createDataFrame([("a", 2), ("b", 1), ("c", 1)], "source_file string, chunk_count long")
    stored = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("d",)], "source_file string")
    got = {r["source_file"]: (r["expected"], r["stored"], r["matches"]) for r in reports.reconcile(expected, stored).collect()}
    assert got == {"a": (2, 2, True), "b": (1, 2, False), "c": (1, 0, False), "d": (0, 1, False)}


def test_health_levels(spark):
    rows = [row(f"s{i}", "success", 1, 1000, second=i, duration=7.0) for i in range(97)]
    rows += [row("t1", "timeout"), row("t2", "timeout"), row("e", "error")]
    got = {r["metric"]: r["level"] for r in reports.health_alerts(log(spark, rows)).collect()}
    assert got["timeout_rate"] == "warn" and got["error_rate"] == "ok" and got["files_per_second"] == "ok"
    assert got["avg_duration_s"] == "warn" and got["chunks_per_second"] == "ok"


def test_labels_and_objects(spark):
    df = log(spark, [row("a", "success", 1, 2), row("a", "success", 1, 2), row("b", "empty")])
    assert reports.output_objects(df).head()[0] == 1
    assert reports.collection_label(df, "docs").head()[0] == "docs:3"
