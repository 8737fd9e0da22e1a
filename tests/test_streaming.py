import json
import time

from passagemill.plans import ask
from passagemill.streaming.ingest import ProgressLog, _write_batch, current_rows, ingest_stream, question_stream, text_chunks

SCHEMA = "doc_id long, text string"


def drop(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def run(spark, tmp_path):
    ingest_stream(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), SCHEMA, files_per_batch=1
    ).awaitTermination()


def test_stream_takes_new_files_once(spark, tmp_path):
    seen = ProgressLog()
    spark.streams.addListener(seen)
    drop(tmp_path / "in", "1.json", [{"doc_id": 1, "text": "a\nb"}, {"doc_id": 2, "text": "w " * 300}])
    run(spark, tmp_path)
    run(spark, tmp_path)
    rows = current_rows(spark, str(tmp_path / "out"))
    assert sorted((r["source_file"], r["chunk_index"]) for r in rows.collect()) == [("1", 0), ("2", 0), ("2", 1)]
    # a newer version of document 2 replaces the older one
    drop(tmp_path / "in", "2.json", [{"doc_id": 2, "text": "short"}, {"doc_id": 3, "text": "new"}])
    run(spark, tmp_path)
    got = sorted((r["source_file"], r["text"]) for r in current_rows(spark, str(tmp_path / "out")).collect())
    assert got == [("1", "a\nb"), ("2", "short"), ("3", "new")]
    for _ in range(100):  # events arrive a little later
        if sum(n for _, n, _ in seen.seen) >= 4:
            break
        time.sleep(0.1)
    spark.streams.removeListener(seen)
    assert sum(n for _, n, _ in seen.seen) >= 4


def test_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    batch = text_chunks(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA))
    for _ in range(2):
        _write_batch(batch, 0, "s", str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_questions_as_files(spark, tmp_path):
    drop(tmp_path / "q", "1.json", [{"qid": 1, "question": " red "}, {"qid": 2, "question": "quit"}])
    chunks = spark.createDataFrame([("f", 0, "red"), ("g", 0, "blue")], "source_file string, chunk_index long, text string")
    from passagemill.plans.ingest import collection_rows

    collection, _ = collection_rows(chunks)
    question_stream(
        spark, str(tmp_path / "q"), str(tmp_path / "a"), str(tmp_path / "cp"), lambda q: ask.ask(collection, q)
    ).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "a")).collect()
    assert [(r["qid"], r["answer"]) for r in rows] == [(1, "red")]


def test_documents_in_a_folder_of_part_files(spark, sf, tmp_path):
    """A table of several files is a folder, in which a filter on the table's name finds nothing (F4)."""
    from passagemill.plans import catalogue

    spark.read.parquet(f"{sf}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = catalogue.stream_ingest(spark, sf)
    got = catalogue.stream_ingest(spark, str(tmp_path))
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
