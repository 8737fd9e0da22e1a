import random
import re

import pytest
from check import compare, oracle_connection
from conftest import SF

from llm_rows import odd  # noqa: F401

from passagemill.llm import decontaminate as d


def brute(docs, items, n=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - n + 1)) if w else ():
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                own = grams.get(tuple(w[k : k + size]))
                if own is not None:
                    hit.update(range(k, k + size))
                    found.update(str(x) for x in own if x is not None)
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(docs, bench, **more):
    rows = d.decontaminate(docs, bench, **more).collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r.hit_spans) == r.n_hit and r.contaminated == (r.n_hit > 0)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows), key=str)


@pytest.mark.parametrize("block_bytes", [16 << 20, 2000])
def test_random_texts(spark, block_bytes):
    rng = random.Random(4)
    vocabulary = ["a", "bb", "Ccc", "don't", "é", "x1", "longerword", "漢字"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 9, 10, 11, 30]))) for i in range(30)] + [(3, "same id"), (None, "a bb a bb"), (99, None), (98, "!!")]
    items = [x for x in items if x[1] not in ("a", "bb")]
    docs = []
    for i in range(60):
        t = text(rng.randrange(0, 60))
        if i % 3 == 0:
            t = t + " " + (rng.choice(items)[1] or "").upper()
        docs.append((i, t))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = run(spark.createDataFrame(docs, "doc_id bigint, text string"), bench, block_bytes=block_bytes)
    assert got == brute(docs, items)


def test_awkward_rows(spark, odd):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "no id"), (10, "word " * 12)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = odd("n_hit")
    got = run(docs, bench)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], items)
    found = d.decontaminate(docs, bench)
    assert set(found.columns) >= {"other", "lang"} and found.columns.count("n_hit") == 1
    assert d.decontaminate(docs.limit(0), bench).count() == 0
    assert d.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0


def test_sql(spark):
    verdict, _, _ = compare(spark, oracle_connection(SF), SF, "op1_decontamination")
    assert verdict.startswith("ok"), verdict
