import json

import pytest

from passagemill.streaming import compaction as c
from passagemill.streaming.ingest import current_rows, ingest_stream, latest_versions

SCHEMA = "doc_id long, text string"


def drop(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def run(spark, tmp_path, stream="ingest", checkpoint="cp"):
    ingest_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / checkpoint), SCHEMA, files_per_batch=1, stream_id=stream).awaitTermination()


def now(spark, tmp_path):
    return sorted((r["source_file"], r["chunk_index"], r["text"]) for r in current_rows(spark, str(tmp_path / "out")).collect())


def stored(spark, tmp_path):
    """All rows in data files of the collection, live or not."""
    base = c.base_of(str(tmp_path / "out"))
    n = c.newest_base(spark, str(tmp_path / "out"))
    rows = spark.read.parquet(f"{base}/{n}/rows").count()
    left = c._batches(spark, str(tmp_path / "out"))
    return rows + (left.count() if left is not None else 0)


@pytest.fixture()
def streamed(spark, tmp_path):
    drop(tmp_path / "in", "1.json", [{"doc_id": i, "text": f"text {i}"} for i in range(6)])
    run(spark, tmp_path)
    drop(tmp_path / "in", "2.json", [{"doc_id": 1, "text": "newer"}, {"doc_id": 2, "text": ""}])
    run(spark, tmp_path)
    return tmp_path


def test_live_rows_only_and_unchanged(spark, streamed):
    before = now(spark, streamed)
    report = c.compact(spark, str(streamed / "out")).first()
    assert (report.snapshot, report.live_rows, report.documents, report.tombstones) == (1, 5, 6, 1)
    assert now(spark, streamed) == before and stored(spark, streamed) == 5
    # again, with nothing new
    assert c.compact(spark, str(streamed / "out")).first().live_rows == 5
    assert now(spark, streamed) == before and stored(spark, streamed) == 5


def test_the_stream_goes_on_after_it(spark, streamed):
    c.compact(spark, str(streamed / "out"))
    drop(streamed / "in", "3.json", [{"doc_id": 1, "text": "newest"}, {"doc_id": 2, "text": "back"}, {"doc_id": 9, "text": "nine"}, {"doc_id": 0, "text": " "}])
    run(spark, streamed)
    want = [("1", 0, "newest"), ("2", 0, "back"), ("3", 0, "text 3"), ("4", 0, "text 4"), ("5", 0, "text 5"), ("9", 0, "nine")]
    assert now(spark, streamed) == want
    c.compact(spark, str(streamed / "out"))
    assert now(spark, streamed) == want and stored(spark, streamed) == 6


def test_replayed_batches_are_not_looked_at(spark, streamed):
    before = now(spark, streamed)
    c.compact(spark, str(streamed / "out"))
    run(spark, streamed, checkpoint="lost")  # the checkpoint is gone: all batches come once more, under their old numbers
    assert now(spark, streamed) == before
    c.compact(spark, str(streamed / "out"))
    assert now(spark, streamed) == before and stored(spark, streamed) == 5


def test_tombstones_hold_against_older_files_of_another_stream(spark, streamed):
    c.compact(spark, str(streamed / "out"))
    run(spark, streamed, stream="other", checkpoint="cp2")  # the same files, with their times
    assert [r[:2] for r in now(spark, streamed)] == [("0", 0), ("1", 0), ("3", 0), ("4", 0), ("5", 0)]
    assert ("1", 0, "newer") in now(spark, streamed)


def test_a_compaction_that_fails_changes_nothing(spark, streamed, monkeypatch):
    before = now(spark, streamed)
    monkeypatch.setattr(c, "mark_done", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        c.compact(spark, str(streamed / "out"))
    assert now(spark, streamed) == before and c.newest_base(spark, str(streamed / "out")) is None
    monkeypatch.undo()
    assert c.compact(spark, str(streamed / "out"), clean=False).first().snapshot == 2
    assert now(spark, streamed) == before
    c.clean_up(spark, str(streamed / "out"))
    assert now(spark, streamed) == before and stored(spark, streamed) == 5


def test_latest_version_of_repeated_documents(spark):
    rows = [(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "d", 1), (None, "e", 3), (3, "same", 1), (3, "same", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __version int")
    got = sorted(((r.doc_id, r.text) for r in latest_versions(df, "doc_id").collect()), key=str)
    assert got == [(1, "b"), (2, "c"), (3, "same"), (None, "e")]


def test_nothing_streamed_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        current_rows(spark, str(tmp_path / "never"))
