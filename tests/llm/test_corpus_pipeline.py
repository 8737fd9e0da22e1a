from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as p
from test_decontaminate import brute
from test_simhash import brute_print, groups
from llm_rows import odd  # noqa: F401

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    """Each stage's decisions against brute force on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for i, (name, stage) in enumerate(p.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        kept[name] = (before.collect(), docs.collect())
        if i < len(p.STAGES) - 1:
            assert docs.columns == COLUMNS
    clean, left = kept["toxicity"]
    assert len(left) >= 0.8 * len(clean) and set(left) <= set(clean)

    before, left = kept["simhash near-dedup"]
    rows = sorted(before, key=lambda r: r.doc_id)
    roots = set(groups([brute_print(r.text) for r in rows]))
    assert sorted(left, key=lambda r: r.doc_id) == [rows[i] for i in sorted(roots)]

    before, left = kept["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {i for i, _, n, _ in brute([(r.doc_id, r.text) for r in before], items) if n}
    assert hit and Counter(left) == Counter(r for r in before if r.doc_id not in hit)

    before, left = kept["mixing"]
    copies = Counter(r.doc_id for r in left)
    assert max(copies.values()) == 2 and set(left) <= set(before)

    before, left = kept["sharding"]
    assert Counter(tuple(r[c] for c in COLUMNS) for r in left) == Counter(map(tuple, before))
    counts = Counter(r["shard"] for r in left)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_run(spark):
    rows = p.run(spark, SF)
    assert rows.columns == [*COLUMNS, "shard", "slot"] and rows.count() > 100


CLASH = (
    "score predicted neighbours fp fingerprint component_id n_words n_hit items hit_spans contaminated size source_size "
    "target copies taken bucket pos place row id t h best n"
).split()


def test_clashing_columns_come_through(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for i, c in enumerate(CLASH):
        docs = docs.withColumn(c, F.col("doc_id") * 100 + i)
    docs.write.parquet(str(tmp_path / "clash"))
    docs = spark.read.parquet(str(tmp_path / "clash"))
    for _, stage in p.STAGES:
        rows = stage(spark, docs, SF).collect()
        assert rows and all(r[c] == r.doc_id * 100 + i for r in rows for i, c in enumerate(CLASH))


def test_awkward_rows(spark, odd):
    docs = odd("n_chars").drop("other").select(*COLUMNS)
    for _, stage in p.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[:5] == COLUMNS
        assert out.count() >= 1
    empty = odd("n_chars", rows=[]).drop("other").select(*COLUMNS)
    for _, stage in p.STAGES:
        assert stage(spark, empty, SF).count() == 0
