import hashlib

import pytest
from check import compare, oracle_connection
from conftest import SF
from llm_rows import odd  # noqa: F401
from pyspark.sql import functions as F

from passagemill.llm import merkle

FIELDS = ["doc_id", "source", "lang", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row):
    return h(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def brute_tree(leaves, fanout):
    """Levels of digests, from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def brute_proof(levels, i, fanout):
    steps = []
    for below in levels[:-1]:
        start = i - i % fanout
        run = below[start : start + fanout]
        steps.append(("".join(run[: i - start]), "".join(run[i - start + 1 :])))
        i //= fanout
    return steps


def brute(rows, fanout):
    """Sorted (id, leaf, subroot, root, steps), and the root."""
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, brute_leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [brute_tree([x[2] for x in sorted(groups[s])], fanout) for s in names]
    top = brute_tree([t[-1][0] for t in trees], fanout) if trees else [[None]]
    out = []
    for g, (s, tree) in enumerate(zip(names, trees)):
        for i, (known, doc_id, leaf) in enumerate(sorted(groups[s])):
            steps = brute_proof(tree, i, fanout) + brute_proof(top, g, fanout)
            out.append((doc_id if known else None, leaf, tree[-1][0], top[-1][0], steps))
    return sorted(out, key=str), top[-1][0]


def found(proofs):
    rows = proofs.collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.steps]) for r in rows), key=str)


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_odd_rows(odd, monkeypatch, fanout):
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    df = odd("rank")
    want, root = brute(df.collect(), fanout)
    m = merkle.manifest(df, FIELDS, keep=["doc_id", "rank", "other"])
    proofs = merkle.prove(m)
    assert found(proofs) == want and m.root() == root
    assert {r["rank"] for r in proofs.collect()} == {7}
    folded = proofs.select((merkle.fold(F.col("leaf"), F.col("steps")) == F.col("root")).alias("ok"))
    assert all(r.ok for r in folded.collect())


def test_deep_trees_on_real_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(merkle, "FANOUT", 3)
    df = spark.read.parquet(f"{sf}/documents.parquet")
    df = df.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise(F.col("source")))
    want, root = brute(df.collect(), 3)
    assert found(merkle.prove(merkle.manifest(df, FIELDS))) == want
    # neither partitions nor the size of the ranges change the root
    monkeypatch.setattr(merkle, "LEAVES_A_RANGE", 7)
    assert merkle.manifest(df.repartition(5), FIELDS).root() == root


def test_a_changed_row_is_told_by_its_proof(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumn("changed", merkle.leaf(*map(F.col, FIELDS[:3]), F.concat("text", F.lit("!"))))
    proofs = merkle.prove(merkle.manifest(df, FIELDS, keep=["doc_id", "changed"]))
    assert proofs.where(merkle.fold(F.col("changed"), F.col("steps")) == F.col("root")).count() == 0


def test_kept_columns_named_like_results_give_way(odd):
    proofs = merkle.prove(merkle.manifest(odd("root"), FIELDS, keep=["doc_id", "root", "other"]))
    assert proofs.columns == ["doc_id", "other", "leaf", "subroot", "root", "steps"]


def test_intervals_of_nodes_nest(spark, sf, monkeypatch):
    monkeypatch.setattr(merkle, "FANOUT", 4)
    rows = merkle.nodes(merkle.manifest(spark.read.parquet(f"{sf}/documents.parquet"), FIELDS)).collect()
    by_level = {(r.tree, r.level, r.lo): r for r in rows}
    for r in rows:
        if r.level:
            below = sorted((x.lo, x.hi, x.digest) for x in rows if (x.tree, x.level) == (r.tree, r.level - 1) and r.lo <= x.lo and x.hi <= r.hi)
            assert [lo for lo, _, _ in below] == [r.lo] + [hi for _, hi, _ in below[:-1]] and below[-1][1] == r.hi
            assert r.digest == h(*[d for _, _, d in below])
    assert len(by_level) == len(rows)


def test_empty_and_lone(spark):
    df = spark.createDataFrame([(1, None, None, None)], "doc_id bigint, source string, lang string, text string")
    m = merkle.manifest(df.limit(0), FIELDS)
    assert merkle.prove(m).collect() == [] and m.root() is None
    (only,) = merkle.prove(merkle.manifest(df, FIELDS)).collect()
    assert only.leaf == only.subroot == only.root == h("1:1", "-", "-", "-") and only.steps == []


def test_registered_query(spark):
    verdict, _, _ = compare(spark, oracle_connection(SF), SF, "op11_merkle_manifest")
    assert verdict.startswith("ok"), verdict
