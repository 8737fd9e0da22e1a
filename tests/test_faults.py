"""Nothing is lost or decided by chance: deep folders, over-long texts, ties, versions, failures."""

import json
import os
import subprocess
import sys
import textwrap
import time

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from passagemill.config import CollectionConfig, ParseConfig, SearchConfig
from passagemill.operators.batchmap import parse_tasks
from passagemill.operators.chunking import greedy_chunks
from passagemill.operators.embedding import EndpointEmbedder, LocalEmbedder, embed
from passagemill.operators.generation import replies
from passagemill.operators.ivf import Centroids, assign_cells, assign_cells_of, seed_centroids, train_centroids
from passagemill.operators.search import top_k
from passagemill.operators.units import explode_units, html_units, line_units
from passagemill.plans import ask, ingest
from passagemill.sources import collection as store
from passagemill.sources.files import list_files
from passagemill.streaming.ingest import current_rows, ingest_stream, log_of, rejects_of

LONG = "x" * 40_000


def test_deep_folders_and_links(spark, tmp_path):
    deep = tmp_path
    for i in range(70):
        deep = deep / f"d{i}"
    deep.mkdir(parents=True)
    (deep / "deep.pdf").write_text("a")
    (tmp_path / "top.pdf").write_text("b")
    os.symlink(tmp_path, tmp_path / "d0" / "loop")
    found = [os.path.basename(r.path) for r in list_files(spark, str(tmp_path)).collect()]
    assert sorted(found) == ["deep.pdf", "top.pdf"]


def test_parse_tasks_grow_with_the_files():
    config = ParseConfig()
    assert parse_tasks(10, 8, config) == 80
    assert parse_tasks(1_000_000, 8, config) == 15_625
    assert parse_tasks(0, 8, ParseConfig(workers=2, blocks_per_worker=3)) == 6


def _drop(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))
    time.sleep(0.05)  # files of different times


def _stream(spark, tmp_path, checkpoint="cp", stream_id="ingest"):
    ingest_stream(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / checkpoint), "doc_id long, text string",
        files_per_batch=100, stream_id=stream_id,
    ).awaitTermination()


def test_stream_keeps_rejects_and_status(spark, tmp_path):
    _drop(tmp_path / "in", "1.json", [{"doc_id": 1, "text": LONG}, {"doc_id": 2, "text": "fine"}, {"doc_id": 3, "text": " "}])
    _stream(spark, tmp_path)
    out = str(tmp_path / "out")
    assert [r.source_file for r in current_rows(spark, out).collect()] == ["2"]
    rejected = spark.read.parquet(rejects_of(out)).collect()
    assert [(r.source_file, r.text == LONG, r.problem) for r in rejected] == [("1", True, "text too long")]
    log = {r.source_file: r.status for r in spark.read.parquet(log_of(out)).collect()}
    assert log == {"1": "success", "2": "success", "3": "empty"}


def test_versions_go_by_time(spark, tmp_path):
    out = str(tmp_path / "out")
    now = lambda: sorted((r.source_file, r.text) for r in current_rows(spark, out).collect())
    for i in range(3):
        _drop(tmp_path / "in", f"{i}.json", [{"doc_id": 1, "text": f"version {i}"}])
        _stream(spark, tmp_path)
    # a newer stream starts at batch 0 again, and sees two versions in one batch
    _drop(tmp_path / "in", "8.json", [{"doc_id": 1, "text": "eight"}, {"doc_id": 2, "text": "two"}])
    _drop(tmp_path / "in", "9.json", [{"doc_id": 1, "text": "nine"}])
    _stream(spark, tmp_path, "cp2", "second")
    assert now() == [("1", "nine"), ("2", "two")]
    # a version without chunks replaces what was there
    _drop(tmp_path / "in", "99.json", [{"doc_id": 1, "text": ""}])
    _stream(spark, tmp_path, "cp2", "second")
    assert now() == [("2", "two")]


def test_append_keeps_rejects(spark):
    config = CollectionConfig("kept", "faults")
    chunks = spark.createDataFrame([("f", i, t) for i, t in enumerate(["red", "blue", LONG])], "source_file string, chunk_index long, text string")
    centroids = Centroids(seed_centroids(embed(chunks, None), "chunk_index", 2))
    ingest.load_step(chunks.filter("chunk_index = 0"), config, centroids=centroids)
    for _ in range(2):
        ingest.append_indexed(chunks, config, centroids)
    assert sorted(r.text for r in store.open_collection(spark, config).collect()) == ["blue", "red"]
    rejects = store.open_collection(spark, CollectionConfig("kept__rejected", "faults")).collect()
    assert [r.text for r in rejects] == [LONG]


def test_failed_layout_leaves_the_old_collection(spark, monkeypatch):
    config = CollectionConfig("safe", "faults", 2)
    rows = spark.createDataFrame([(1, "a", 0, "t", [1.0, 0.0], 3)], "id long, source_file string, chunk_index long, text string, embedding array<float>, cell_id int")
    store.create_or_replace(rows, config, "cell_id")

    def broken(*_):
        raise RuntimeError("no layout today")

    monkeypatch.setattr(store, "even_files", broken)
    with pytest.raises(RuntimeError, match="no layout"):
        store.create_or_replace(rows.unionByName(rows), config, "cell_id")
    assert store.open_collection(spark, config).count() == 1


def test_ties_do_not_depend_on_batches(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 48))
    base /= np.sqrt((base * base).sum(1, keepdims=True))
    rows = [(i, [float(np.float32(x)) for x in base[i % 40]]) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = table.select(F.col("vec_id").alias("qid"), "embedding").filter("qid < 60")
    seen = set()
    try:
        for parts, batch, config in (
            (1, 997, SearchConfig()), (3, 100, SearchConfig()), (7, 37, SearchConfig()),
            (3, 64, SearchConfig(broadcast_bytes=0, block_rows=90, block_queries=20)),
            (5, 10_000, SearchConfig(candidate_rows=0, block_rows=1000)),
        ):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            hits = top_k(table.repartition(parts), asked, ["vec_id"], config=config).collect()
            seen.add(tuple(sorted((r.qid, r.rk, r.vec_id, r.score) for r in hits)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(seen) == 1
    # the ten copies of a vector are equally close: the smallest keys win
    assert [v for q, _, v, _ in next(iter(seen)) if q == 47] == [7, 47, 87, 127, 167]


def test_many_centroids_are_searched_like_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    centroids = train_centroids(table, 8)
    want = {r.vec_id: r.cell_id for r in assign_cells(table, Centroids(centroids)).collect()}
    found = assign_cells_of(table, centroids, "vec_id", config=SearchConfig(broadcast_bytes=0, block_rows=4, block_queries=30))
    assert {r.vec_id: r.cell_id for r in found.collect()} == want


def test_missing_texts_have_no_vector(spark):
    df = spark.createDataFrame([("a",), (None,), ("bb",)], "text string").coalesce(1)
    local = LocalEmbedder(lambda: lambda texts: [[float(len(t))] for t in texts], normalize=False)
    assert [r.embedding for r in embed(df, local).collect()] == [[1.0], None, [2.0]]
    assert [r.embedding is None for r in embed(df, None, dim=4).collect()] == [False, True, False]


@pytest.mark.parametrize("indexes", [[0, 0], [0], [0, 5]])
def test_replies_out_of_order(spark, indexes):
    client = lambda: lambda payload: {"data": [{"index": i, "embedding": [1.0]} for i in indexes]}
    with pytest.raises(ValueError, match="vectors"):
        EndpointEmbedder(client, "m").load()(["a", "b"])


def test_one_failed_answer_does_not_stop_the_others(spark):
    class Moody:
        def load(self):
            def ask_one(prompt):
                if prompt == "bad":
                    raise OSError("503")
                return prompt.upper()

            return ask_one

    df = spark.createDataFrame([("a",), ("bad",), (None,), ("c",)], "prompt string").coalesce(1)
    got = df.select(replies(F.col("prompt"), Moody()).alias("r")).collect()
    assert [(r.r.answer, r.r.error) for r in got] == [("A", None), (None, "OSError: 503"), (None, None), ("C", None)]


def test_each_question_is_embedded_once(spark, tmp_path):
    seen = str(tmp_path / "seen")

    class Counting:
        def load(self):
            def encode(texts):
                with open(seen, "a") as f:
                    f.write("".join(t + "\n" for t in texts))
                return [[float(len(t)), 1.0] for t in texts]

            return encode

    table = spark.createDataFrame([("s", i, [1.0, float(i)]) for i in range(20)], "source_file string, chunk_index long, embedding array<float>")
    asked = spark.createDataFrame([(i, f"question {i}") for i in range(50)], "qid long, question string")
    for config in (SearchConfig(), SearchConfig(broadcast_bytes=0)):
        open(seen, "w").close()
        assert ask.retrieve(table, asked, Counting(), config=config).count() == 250
        assert sorted(open(seen).read().split("\n")[:-1]) == sorted(f"question {i}" for i in range(50))


def test_from_any_folder(tmp_path):
    """Searches run where the package can't be imported by the workers."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    program = textwrap.dedent(
        f"""
        import importlib.util, sys
        spec = importlib.util.spec_from_file_location("__spark_entry__", "{root}/__spark_entry__.py")
        entry = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(entry)
        sys.path.remove("{root}")
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", "{tmp_path}/scratch").getOrCreate())
        for name in ("topk_single", "topk_batch", "topk_blocks", "ivf_topk", "ivf_assign", "rag_sources"):
            print(name, len(entry.queries()[name](spark, "{SF}").collect()))
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert all(int(line.split()[1]) > 0 for line in done.stdout.splitlines()) and len(done.stdout.splitlines()) == 6


PAGE = """<html><head><title>A &mdash; B</title><style>p {x}</style></head><body><!-- no -->
<h2>Caf&eacute; &#8217;s</h2><p>one&nbsp;&amp;lt; &#x27;two&#x27; &unknown; & &#0; &#xD800;</p><ul><li>x&lt;y<li>z</ul>loose
<table><tr><td>a</td><td>b</td></tr></table><script>var p = "<p>no</p>";</script></body></html>"""


def test_page_units_by_hand(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "no markup"), (3, "")], "page_id long, html string")
    got = [(r.page_id, r.kind, r.heading, r.text) for r in explode_units(html_units(df, "html"), ["page_id"]).orderBy("page_id", "unit_no").collect()]
    cafe = "Café ’s"
    assert got == [
        (1, "title", "A — B", "A — B"),
        (1, "h2", cafe, cafe),
        (1, "p", cafe, "one &lt; 'two' &unknown; & \ufffd \ufffd"),
        (1, "li", cafe, "x<y"),
        (1, "li", cafe, "z"),
        (1, "text", cafe, "loose"),
        (1, "tr", cafe, "a b"),
        (2, "text", "", "no markup"),
    ]


def test_long_documents_pack_in_linear_time(spark):
    spent = []
    for n in (100_000, 400_000):
        df = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: i.cast("string")), "\n").alias("text"))
        began = time.time()
        assert greedy_chunks(line_units(df, "text"), cap=1, collapsed=True).select(F.size("chunks")).head()[0] == n
        spent.append(time.time() - began)
    assert spent[1] < 12 * spent[0] + 5
