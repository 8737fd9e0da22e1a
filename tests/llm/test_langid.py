import numpy as np
from pyspark.sql import functions as F

from llm_rows import odd  # noqa: F401

from passagemill.llm import langid
from passagemill.llm.common import id_remainder


def test_gradient():
    """The hand-made gradient agrees with differences."""
    rng = np.random.default_rng(1)
    x, y = rng.integers(1, 256, (5, 20)).astype(np.uint8), rng.integers(0, 3, 5)
    wide = len(langid.WIDTHS) * langid.FILTERS
    p = [rng.normal(0, 1, (256, langid.EMBED))] + [rng.normal(0, 1, (w * langid.EMBED, langid.FILTERS)) for w in langid.WIDTHS]
    p = [a.astype(np.float64) for a in p + [rng.normal(0, 1, (wide, 3)), np.zeros(3)]]
    weight = np.ones(5)

    def loss():
        model = (["a", "b", "c"], p[0], p[1:-2], p[-2], p[-1])
        return -langid.window_scores(model, x)[np.arange(5), y].astype(float).mean()

    grads = langid._gradient(p, x, y, weight)
    for a, g in zip(p, grads):
        for at in zip(*[rng.integers(0, s, 6) for s in a.shape]):
            old = a[at]
            a[at] = old + 1e-3
            up = loss()
            a[at] = old - 1e-3
            down = loss()
            a[at] = old
            assert abs((up - down) / 2e-3 - g[at]) < 2e-2 + 0.05 * abs(g[at])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = id_remainder("doc_id", 4) == 2
    examples = langid.sample(docs, "text", "lang", "doc_id", ~held, per_language=60)
    assert max(np.unique([e[0] for e in examples], return_counts=True)[1]) <= 60
    found = langid.identify(docs.where(held), langid.train(examples)).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95 and all(0 <= r.score <= 1 for r in found)


def test_whole_texts_count():
    """What stands at the end of a long text weighs as much as its beginning."""
    rng = np.random.default_rng(3)
    make = lambda letters, n: "".join(rng.choice(list(letters), n))
    examples = [("x", [make("abc ", 256).encode()] * 3) for _ in range(80)] + [("y", [make("def ", 256).encode()] * 3) for _ in range(80)]
    model = langid.train(examples)
    short, long = make("abc ", 300), make("def ", 9000)
    assert [p for p, _ in langid.classify(model, [short, long, short + long, long + short, "abc", "  1", None])] == ["x", "y", "y", "y", "x", "und", "und"]


def test_awkward_rows(spark, odd):
    docs = odd("score")
    model = langid.train(langid.sample(docs, "text", "lang", "doc_id", F.lit(True)))
    rows = langid.identify(docs, model)
    found = rows.collect()
    assert len(found) == 12 and rows.columns.count("score") == 1
    assert {r.lang_pred for r in found if not (r.text or "").strip()} == {"und"}
    assert {r.lang_pred for r in found if (r.text or "").strip()} <= {"en", "fr", "de"}
    empty = odd("x", rows=[])
    none = langid.train(langid.sample(empty, "text", "lang", "doc_id", F.lit(True)))
    assert langid.identify(empty, none).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}


def test_every_language_is_learned(spark, monkeypatch):
    rows = [(3 * i + j, f"text {j} of language {i}", f"l{i:03}") for i in range(230) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = [x for x, _ in langid.sample(docs, "text", "lang", "doc_id", F.lit(True))]
    assert len(found) == 690 and len(set(found)) == 230
    monkeypatch.setattr(langid, "SAMPLE_TEXTS", 460)
    found = [x for x, _ in langid.sample(docs, "text", "lang", "doc_id", F.lit(True))]
    assert len(found) == 460 and len(set(found)) == 230
