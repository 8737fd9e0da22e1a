import numpy as np
from pyspark.sql import functions as F

from llm_rows import odd  # noqa: F401

from passagemill.llm import toxicity as t


def test_search_is_exact():
    rng = np.random.default_rng(1)

    def some(n):
        out = []
        for _ in range(n):
            terms = np.sort(rng.choice(50, rng.integers(1, 12), replace=False))
            w = rng.random(len(terms))
            out.append((terms, w / np.sqrt((w * w).sum())))
        return out

    examples, queries = some(500), some(80)
    examples[10] = examples[11] = examples[300]  # ties
    dense = lambda v: np.array([np.bincount(a, b, 50) for a, b in v])
    want = np.round(dense(queries) @ dense(examples).astype(np.float32).astype(float).T, 12)
    cos, who = t.nearest(t.build_index(examples, 50), queries, 7)
    for i in range(len(queries)):
        order = np.lexsort((np.arange(500), -want[i]))[:7]
        assert np.allclose(cos[i], want[i][order], atol=1e-11)
        assert [w for w, c in zip(who[i], cos[i]) if c > cos[i][-1]] == [w for w in order if want[i][w] > want[i][order[-1]]]


def test_search_is_exact_over_rare_and_frequent_terms():
    rng = np.random.default_rng(4)

    def some(n):
        out = []
        for _ in range(n):
            terms = np.unique(np.concatenate((rng.choice(20, 6, replace=False), rng.integers(20, 4000, 30))))
            w = rng.random(len(terms))
            out.append((terms, w / np.sqrt((w * w).sum())))
        return out

    examples, queries = some(300), [*some(90), (np.array([25]), np.ones(1)), (np.zeros(0, np.int64), np.zeros(0))]
    index = t.build_index(examples, 4000)
    assert 0 < len(index[5][0]) < 50 and len(index[2]) > 5000
    dense = lambda v: np.array([np.bincount(a, b, 4000) for a, b in v])
    want = np.round(dense(queries) @ dense(examples).astype(np.float32).astype(float).T, 12)
    cos, who = t.nearest(index, queries, 7)
    for i in range(len(queries)):
        order = [j for j in np.lexsort((np.arange(300), -want[i]))[:7] if want[i][j] > 0]
        assert np.allclose(cos[i][: len(order)], want[i][order], atol=1e-11) and (who[i][len(order) :] == -1).all()


def test_every_term_of_the_examples_counts(spark):
    """A term of one example, or of clean ones, makes neighbours as well."""
    rows = [(1, "alpha beta onlyonce"), (2, "gamma delta"), (3, "epsilon zeta"), (4, "onlyonce"), (5, "zeta"), (6, "omega")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, toxic int")
    found = {r.doc_id: [n.id for n in r.neighbours] for r in t.toxicity(docs, t.train(docs, labels, F.lit(True))).collect()}
    assert found[4] == ["1"] and found[5] == ["3"] and found[6] == []


def test_whole_runs_bring_terms(spark):
    """Words behind punctuation without a space, in scripts without spaces and far inside long runs."""
    rows = [(1, "alpha slurry"), (2, "gamma delta"), (3, "他是一个大笨蛋。"), (4, "喂你这个笨蛋啊"), (5, "x/slurry"), (6, "x,slurry"), (7, "é—slurry")]
    rows += [(8, "q" * 90 + "slurry" + "q" * 90), (9, "あ" * 40 + "笨蛋"), (10, "q" * 80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id bigint, toxic int")
    found = {r.doc_id: [n.id for n in r.neighbours] for r in t.toxicity(docs, t.train(docs, labels, F.lit(True))).collect()}
    assert all(found[i] == ["1"] for i in (5, 6, 7, 8)) and found[4] == found[9] == ["3"] and found[10] == []


def test_monotone_curve():
    x, y = t.monotone(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert y.tolist() == [0.0, 0.5, 1.0] and (np.diff(x) > 0).all()


def _corpus(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(400):
        w = [f"w{k}" for k in rng.integers(0, 300, 40)]
        bad = i % 8 == 0
        if bad:
            w[3], w[9], w[20] = "Nasty,", "vile", "horridish" if i % 16 else "horridly"
        rows.append((i, " ".join(w), "xx", "s"))
        labels.append((i, int(bad)))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "d"))
    return spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out(spark, tmp_path):
    docs, labels = _corpus(spark, tmp_path)
    model = t.train(docs, labels, F.col("id") % 5 != 0)
    found = t.toxicity(docs, model).where("doc_id % 5 = 0").join(labels, "doc_id").collect()
    assert all(r.predicted == r.toxic and 0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) for r in found)
    bad = next(r for r in found if r.toxic)
    assert bad.neighbours[0].toxic == 1 and 0 < bad.neighbours[0].cosine <= 1
    again = t.toxicity(docs.repartition(5), t.train(docs, labels, F.col("id") % 5 != 0)).collect()
    assert {r.doc_id: r.score for r in again if r.doc_id % 5 == 0} == {r.doc_id: r.score for r in found}


def test_awkward_rows(spark, odd, tmp_path):
    docs, labels = _corpus(spark, tmp_path)
    model = t.train(docs, labels.unionByName(spark.createDataFrame([(None, 1), (1, None)], "doc_id bigint, toxic int")), F.lit(True))
    rows = t.toxicity(odd("score"), model)
    found = rows.collect()
    assert len(found) == 12 and rows.columns.count("score") == 1 and "other" in rows.columns
    assert {r.score for r in found if not (r.text or "").strip()} == {model["blank"]} and not any(r.predicted for r in found)
    assert t.toxicity(odd("predicted", rows=[]), model).count() == 0
    none = t.train(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in t.toxicity(docs, none).collect()} == {0.0}
    ones = t.train(docs, labels.where("toxic = 1"), F.lit(True))
    assert {r.predicted for r in t.toxicity(docs, ones).collect()} == {1}


def test_terms_of_slices_are_those_of_each_word():
    """Looked up side by side or one by one, in any mixture of scripts and lengths."""
    import random
    from collections import Counter

    rng = random.Random(5)
    pieces = ["word", "words", "wordsmith", "W", "x" * 23, "x" * 24, "x" * 25, "naïve", "café", "漢字かな", "a—b", "3", "3rd", "é", "abcdefgh", "abcdefghi", "Ab*c", "-", " ", "\n", "\x00", "q" * 200, "ﬁ"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", ".", "  "]) for _ in range(rng.randrange(40))).encode() for _ in range(300)]
    every = sorted({x for s in texts for w in t.words_of(s) for x in t.terms_of(w)})
    for terms in (every, every[::3], [b"wor*"], [], [b"nothing"]):
        number = {x: i for i, x in enumerate(terms)}
        want = {}
        for i, s in enumerate(texts):
            for x, n in Counter(x for w in t.words_of(s) for x in t.terms_of(w)).items():
                if x in number:
                    want[i, number[x]] = n
        for some in (300, 7):
            vocabulary, got = t.Vocabulary(terms), {}
            for at in range(0, 300, some):
                text, term, n = vocabulary.counts(texts[at : at + some])
                assert (np.diff(text * (len(terms) + 1) + term) > 0).all()
                got |= {(at + i, x): c for i, x, c in zip(text.tolist(), term.tolist(), n.tolist())}
            assert got == want
    lone = t.Vocabulary([b"x" * 30]).counts([b"", b"x" * 30 + b" " + b"x" * 30])
    assert [x.tolist() for x in lone] == [[1], [0], [2]]
    empty = t.Vocabulary(every).counts([b"", b" . "])
    assert all(len(x) == 0 for x in empty)
