import hashlib

import pytest
from llm_rows import odd  # noqa: F401

from passagemill.llm import exactdedup
from passagemill.llm.queries import op12_exact_dedup


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))


def brute(rows):
    """(id, text) pairs -> sorted (id, keep_id, size) by comparing whole texts."""
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        out += [(i, max(known) if known else None, len(ids)) for i in ids]
    return sorted(out, key=str)


def check(df, rows, **more):
    found = exactdedup.exact_duplicates(df, **more).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == brute(rows)
    assert sum(r.kept for r in found) == len({low(t) for _, t in rows})
    assert all(r.keep_id == r.doc_id for r in found if r.kept)
    return found


def test_odd_rows(spark, odd):
    df = odd("keep_id")
    found = check(df, [(r.doc_id, r.text) for r in df.collect()])
    assert {r.other for r in found} == {"a", "b", "c", "d"}
    assert exactdedup.exact_duplicates(df).columns.count("keep_id") == 1


def test_extra_columns_come_back_from_deduplicate(odd):
    for name in ("group_size", "Kept"):
        df = odd(name)
        kept = exactdedup.deduplicate(df)
        assert kept.columns == df.columns
        assert {low(r.text) for r in kept.collect()} == {low(r.text) for r in df.collect()}
        assert kept.count() == len({low(r.text) for r in df.collect()})
        assert {r[name] for r in kept.collect()} == {7}


def test_keys_refine(spark):
    same_head = "h" * exactdedup.PREFIX_CHARS
    rows = [
        (1, same_head + "abc"), (2, same_head + "abd"), (3, same_head + "ABC"),  # equal length and prefix
        (4, "x"), (5, "y"), (6, "X"), (7, "É"), (8, "é"), (9, None), (10, ""),  # not lower-cased beyond ASCII
        (11, "K"), (12, "k"), (13, "K"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(df, rows)
    pairs = exactdedup.surviving_pairs(df, "text")
    assert pairs.count() == 4  # the long texts, x, k, the empty ones; y and the letters beyond ASCII have no partner


def test_strings_as_ids_and_empty_table(spark):
    df = spark.createDataFrame([("b", "one"), ("a", "One"), (None, "ONE")], "doc_id string, text string")
    assert {r.keep_id for r in exactdedup.exact_duplicates(df).collect()} == {"b"}
    assert exactdedup.exact_duplicates(df.limit(0)).collect() == []
    assert exactdedup.deduplicate(df.limit(0)).collect() == []


@pytest.mark.parametrize("parts", [1, 7])
def test_hot_group_meets_by_broadcast(spark, monkeypatch, parts):
    monkeypatch.setattr(exactdedup, "HOT_PARTS", 3)
    rows = [(i, "hot text" if i % 2 else f"text {i // 4}") for i in range(400)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts), rows)


def test_a_full_bitmap_only_costs_hashes(spark, monkeypatch):
    monkeypatch.setattr(exactdedup, "BITMAPS", 1)
    rows = [(i, f"text {i % 50_000}") for i in range(60_000)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), rows)


def test_no_python_and_no_text_in_a_shuffle(spark, sf):
    plan = exactdedup.exact_duplicates(spark.read.parquet(f"{sf}/documents.parquet"), keep=["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "text" not in plan.split("== Physical Plan ==")[1]


def test_registered_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = op12_exact_dedup(spark, sf).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == brute(rows)
    digests = {r.doc_id: hashlib.sha256(low(r.text).encode()).hexdigest() for r in rows}
    assert all(r.text_sha256 == digests[r.doc_id] and r.kept == (r.keep_id == r.doc_id) for r in found)
