import pytest
from check import compare, oracle_connection
from conftest import SF, plan_of

from llm_rows import odd  # noqa: F401

from passagemill.llm import common, mixing


def brute_targets(sizes):
    """By the rule itself: cut at the bound, share the excess by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(out[s] for s in over)
        free -= over
    return out


@pytest.mark.parametrize("shipped", [True, False])
def test_targets_and_copies(spark, sf, monkeypatch, shipped):
    if not shipped:
        monkeypatch.setattr(common, "SHIPPED_GROUPS", 0)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    sizes = {}
    for r in rows:
        assert r["size"] == len(r.text.encode().split())
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        rate = r.target / r.source_size
        assert r.copies in (int(rate), int(rate) + 1) and r.copies <= 2 and r.taken == r.copies * r["size"]
    assert mixing.emit(mixed).count() == sum(r.copies for r in rows)
    again = {(r.doc_id, r.copies) for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}
    assert "Python" not in plan_of(mixed) and "Arrow" not in plan_of(mixed)


def test_many_sources(spark):
    """Rates come near over many documents; sources are ranked by code point, null last."""
    rows = [(i, "w " * (1 + i % 7), ["b", "a", "é", "Z", None, "\U0001f600", "ｆ"][i % 7 if i % 3 else 0]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix(docs).groupBy("source").agg({"taken": "sum", "target": "max", "source_size": "max"}).collect()
    want = brute_targets({r.source: r["max(source_size)"] for r in found})
    for r in found:
        assert abs(r["max(target)"] - want[r.source]) < 1e-6
        assert abs(r["sum(taken)"] - want[r.source]) <= 0.12 * want[r.source]


def test_awkward_rows(spark, odd):
    rows = mixing.mix(odd("taken"))
    found = rows.collect()
    assert len(found) == 12 and rows.columns.count("taken") == 1
    assert {r.taken for r in found if not (r.text or "").strip()} == {0}
    assert mixing.mix(odd("size", rows=[])).count() == 0


def test_sql(spark):
    verdict, _, _ = compare(spark, oracle_connection(SF), SF, "op6_mixing")
    assert verdict.startswith("ok"), verdict
