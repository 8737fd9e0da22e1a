import random

import pytest

import numpy as np
from pyspark.sql import functions as F

from llm_rows import odd  # noqa: F401

from passagemill.llm import chunkdedup as c
from passagemill.llm.queries import op8_substring_dedup


def rolled(data: bytes) -> list[int]:
    """Cuts by the rolling hash, byte by byte."""
    h, out = 0, []
    for i, b in enumerate(data):
        h = ((h << 1) + int(c._GEAR[b])) & 0xFFFFFFFF
        if not h & (((1 << c.CUT_BITS) - 1) << (c.MEMORY - c.CUT_BITS)):
            out.append(i + 1)
    return out


def test_cuts_are_those_of_the_rolling_hash():
    data = np.random.default_rng(1).integers(32, 127, 20_000, dtype=np.uint8)
    found = c.cuts(data).tolist()
    assert found == rolled(data.tobytes()) and 400 < len(found) < 850


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def _planted(seed=3, n=200):
    """(rows, planted): every planted document holds one of the passages of 51 to 80 words, the others none."""
    rng = random.Random(seed)
    passages = [_words(rng, rng.randrange(51, 80)) for _ in range(20)]
    rows, planted = [], {}
    for i in range(n):
        t = _words(rng, rng.randrange(30, 300))
        if i % 4 == 0:
            p = (i // 4) % len(passages)
            planted[i] = p
            t = f"{t} {passages[p]} {_words(rng, rng.randrange(5, 90))}"
        rows.append((i, t, "the usual footer of this site with all its rights"))
    return [(i, f"{t}\n{f}") for i, t, f in rows], planted, passages


def test_planted_passages(spark, tmp_path):
    rows, planted, passages = _planted()
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(path)
    docs, texts = c.numbered(spark.read.parquet(path)), dict(rows)
    runs = c.substring_duplicates(docs).collect()
    first = {}
    for d, p in planted.items():
        first.setdefault(p, d)
    later = {d for d, p in planted.items() if first[p] != d}
    assert {r.doc_id for r in runs} == later
    for r in runs:
        own = texts[r.doc_id].encode()[r.start : r.end]
        assert own in passages[planted[r.doc_id]].encode() + b"\n" or any(own in texts[f].encode() for f in r.first_doc_ids)
        assert first[planted[r.doc_id]] in r.first_doc_ids
    cut = {r.doc_id: r.text for r in c.without_duplicates(docs, c.substring_duplicates(docs)).collect()}
    assert all((cut[d] == texts[d]) == (d not in later) for d in texts)
    for r in runs:
        assert len(cut[r.doc_id].encode()) <= len(texts[r.doc_id].encode()) - (r.end - r.start)


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text.encode()) for r in docs.collect())
    seen, want = {}, set()
    for d, t in rows:
        edges = [0, *[x for x in rolled(t) if c.MEMORY <= x < len(t) and t[x] & 0xC0 != 0x80], len(t)]
        runs, pieces = [], []
        for a, b in zip(edges, edges[1:]):
            pieces.append(t[a:b])
            if t[a:b] in seen:
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
        for p in pieces:
            seen.setdefault(p, d)
        want.update((d, a, b) for a, b in runs if b - a >= c.MIN_BYTES)
    assert want and {(r.doc_id, r.start, r.end) for r in c.substring_duplicates(docs).collect()} == want


def test_hot_chunks_are_joined_alike(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {(r.doc_id, r.start, r.end) for r in c.substring_duplicates(docs).collect()}
    monkeypatch.setattr(c, "HOT_COPIES", 2)
    monkeypatch.setattr(c, "HOT_SHARE", 1 << 40)
    assert {(r.doc_id, r.start, r.end) for r in c.substring_duplicates(docs).collect()} == want


def test_awkward_rows(spark, odd):
    runs = c.substring_duplicates(odd("start"), min_bytes=1).collect()
    # rows with one id are one document; the two without an id are told apart by nothing
    assert {r.doc_id for r in runs} <= {8, 9, 6, 5, 4}
    assert c.substring_duplicates(odd("row", rows=[])).count() == 0


def test_repeats_in_one_text_and_among_rows_of_one_id(spark, tmp_path):
    rng = random.Random(8)
    passage, other = _words(rng, 80), _words(rng, 80)
    rows = [(1, f"{passage} {_words(rng, 40)} {passage} {_words(rng, 30)} {passage}")]
    rows += [(2, _words(rng, 60)), (3, f"{_words(rng, 9)} {other}"), (3, f"{_words(rng, 7)} {other}"), (None, f"{_words(rng, 5)} {other}"), (None, other)]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(path)
    docs = c.numbered(spark.read.parquet(path))
    runs = c.repeated_passages(docs)
    found = runs.collect()
    assert sorted((r.doc_id or 0, r.within) for r in found) == [(0, False), (0, False), (1, True), (1, True), (3, False)]
    assert all(r.first_doc_ids == ([1] if r.doc_id == 1 else [3]) and len(r.first_rows) == 1 for r in found)
    left = [r.text for r in c.without_duplicates(docs, runs).collect()]
    assert sum(t.count(passage) for t in left) == 1 and sum(t.count(other) for t in left) == 1


def test_every_occurrence_but_the_first(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text.encode()) for r in docs.collect())
    seen, want = set(), set()
    for d, t in rows:
        edges = [0, *[x for x in rolled(t) if c.MEMORY <= x < len(t) and t[x] & 0xC0 != 0x80], len(t)]
        runs = []
        for a, b in zip(edges, edges[1:]):
            if t[a:b] in seen:
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
            seen.add(t[a:b])
        want.update((d, a, b) for a, b in runs if b - a >= c.MIN_BYTES)
    assert want and {(r.doc_id, r.start, r.end) for r in c.repeated_passages(docs).collect()} == want


def test_passages_are_followed_to_their_ends(spark, tmp_path):
    """Every passage of 51 words is found in each later copy, from its first byte to its last."""
    rng = random.Random(11)
    passages = [_words(rng, 51) for _ in range(300)] + ["é" * 150 + str(i) for i in range(3)]
    rows = [(2 * i + j, f"{_words(rng, 30)} {j}{p}{j} {_words(rng, 30)}") for i, p in enumerate(passages) for j in (0, 1)]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(path)
    docs, texts = spark.read.parquet(path), dict(rows)
    found = {}
    for r in c.whole_passages(docs).collect():
        found.setdefault(r.doc_id, []).append(texts[r.doc_id].encode()[r.start : r.end].decode())
    for i, p in enumerate(passages[:300]):
        assert any(p in x for x in found.get(2 * i + 1, [])), i
    assert all(2 * i + 1 in found for i in range(300, 303))  # of one letter: found, at whichever shift
    short = {r.doc_id for r in c.repeated_passages(docs).collect()}
    assert any(2 * i + 1 not in short for i in range(300))  # what the runs of chunks alone don't reach


def test_grown_runs_hold_the_runs_of_chunks(spark, sf):
    docs = c.numbered(spark.read.parquet(f"{sf}/documents.parquet"))
    grown = {}
    for r in c.whole_passages(docs).collect():
        grown.setdefault(r.row, []).append((r.start, r.end))
    texts = {r.row: r.t for r in docs.select(F.col("__row").alias("row"), F.col("text").cast("binary").alias("t")).collect()}
    for r in c.repeated_passages(docs).collect():
        assert any(a <= r.start and r.end <= b for a, b in grown[r.row])
    for row, spans in grown.items():
        spans.sort()
        assert all(b < a for (_, b), (a, _) in zip(spans, spans[1:])) and all(texts[row][a:b].decode() for a, b in spans)


def test_no_chunk_is_longer_than_the_bound(spark, odd):
    assert c.chunks(odd("size"), longest=c.MAX_CHUNK).agg(F.max("size")).first()[0] <= c.MAX_CHUNK
    assert c.whole_passages(odd("end", rows=[])).count() == 0


def test_input_whose_rows_move_between_scans(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    spans = lambda df: {(r.doc_id, r.start, r.end) for r in c.whole_passages(df).collect()}
    want = spans(docs)
    assert want and spans(docs.repartition(5)) == want
    assert spans(docs.join(docs.select("doc_id").where("doc_id >= 0"), "doc_id")) == want
    with pytest.raises(ValueError):
        c.without_duplicates(docs, c.repeated_passages(docs))


def brute_whole(rows, min_bytes):
    """Bytes that stand, in a row of at least ``min_bytes``, in an earlier text too: by comparing all places of that length."""
    seen, out = set(), {}
    for d, t in rows:
        own = set()
        windows = [t[i : i + min_bytes] for i in range(len(t) - min_bytes + 1)]
        for i, w in enumerate(windows):
            if w in seen:
                own.update(range(i, i + min_bytes))
        seen.update(windows)
        out[d] = own
    return out


def test_registered_result_against_brute_force(spark, sf):
    """What is reported does repeat, and nearly all that repeats over 300 bytes and more is reported."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text.encode()) for r in docs.collect())
    found = {}
    for r in op8_substring_dedup(spark, sf).collect():
        found.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    near = brute_whole(rows, c.MIN_BYTES // 4)
    # repeats of one text are told from each other by place; brute force counts those of other texts
    within = {d: t for d, t in rows}
    for d, places in found.items():
        alone = places - near[d]
        assert len(alone) <= len(places) * 0.2 or any(within[d].count(within[d][i : i + 25]) > 1 for i in sorted(alone)[:1])
    far = brute_whole(rows, 300)
    missed = sum(len(p - found.get(d, set())) for d, p in far.items())
    assert sum(map(len, far.values())) > 10_000 and missed <= 0.01 * sum(map(len, far.values()))
