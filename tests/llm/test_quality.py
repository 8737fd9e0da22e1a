import math
import random
from collections import Counter

from pyspark.sql import functions as F

from llm_rows import odd  # noqa: F401

from passagemill.llm import quality as q
from passagemill.llm.queries import op4_quality

WHITE = " \t\n\x0b\f\r"


def brute(t):
    t = t or ""
    for c in WHITE[1:]:
        flat = t.replace(c, " ") if c == "\t" else flat.replace(c, " ")  # noqa: F821
    words = [w for w in flat.split(" ") if w]
    lines, dup, seen = t.split("\n"), 0, set()
    for x in lines:
        if x.strip(WHITE):
            dup += x in seen
            seen.add(x)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            hit.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_counts(spark, odd):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "b", " ", "\n", "é ", "#", "a b c d e f g h ", "\x85", "\xa0"]) for _ in range(rng.randrange(200))) for _ in range(300)]
    texts = [t for t in texts]
    got = list(zip(*q.counts([t.encode() for t in texts])))
    assert got == [brute(t) for t in texts]
    docs = odd("n_words")
    rows = q.features(docs).collect()
    assert all(tuple(r[f] for f in q.FEATURES) == brute(r.text) for r in rows) and len(rows) == 12


def test_thresholds(spark, tmp_path):
    """Sketch quantiles lie within a bin of the exact ones, and outliers of their own group go."""
    rng = random.Random(2)
    rows = []
    for i in range(900):
        lang, size = ("en", 5) if i % 3 else ("de", 11)
        n = rng.randrange(60, 90)
        words = ["".join(rng.choice("abcdefghij") for _ in range(max(1, round(rng.gauss(size, 1.5))))) for _ in range(n)]
        rows.append((i, " ".join(words), lang, "s" if i % 2 else None))
    rows.append((1000, " ".join("longwordhere"[: 11 + k % 2] + "abcdefghij"[k % 10] for k in range(60)), "en", "s"))  # usual in de only
    rows.append((1001, " ".join(f"wor{k}|" for k in range(60)), "en", "s"))
    rows.append((1002, " ".join("abcdefghij"[k % 10] + "zz" + "klmno"[k % 5] for k in range(7)), "en", "rare"))
    rows.append((1003, " ".join(x[:5] for x in rows[1][1].split()), "xx", "new"))  # a group too small for thresholds of its own
    path = str(tmp_path / "q")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(path)
    found = {r.doc_id: r for r in q.quality(spark.read.parquet(path)).collect()}
    assert "word_length" in found[1000].reasons and "symbols" in found[1001].reasons
    assert found[1002].base_failed and not found[1002].kept
    assert found[1003].kept
    assert sum(not found[i].kept for i in range(900)) <= 9
    rates = q.with_rates(q.features(spark.read.parquet(path)).withColumn("base_failed", q.base_failed()))
    limits = q.thresholds(q.sketches(rates, ["lang"]), ["lang"]).where("rate = 'word_length' and lang = 'en'").first()
    exact = rates.where("lang = 'en' and not base_failed").select(F.percentile("__rate_word_length", F.array(F.lit(0.5), F.lit(0.9)))).first()[0]
    high = exact[1] + q.REACH * (exact[1] - exact[0])
    assert abs(limits.most - high) < 0.25 * high


def _bin(x):
    return -1 if x <= 0 else math.floor(math.log(float(x)) / math.log(q.RATIO))


def _bounds(values, share):
    """Lower and upper bound of the bin in which that share of the sorted values is reached."""
    bins = sorted(map(_bin, values))
    b = next(x for i, x in enumerate(bins) if i + 1 >= share * len(bins))
    return (0.0, 0.0) if b < 0 else (q.RATIO**b, q.RATIO ** (b + 1))


def brute_kept(rows):
    """Verdict of each (lang, source, text), from the sorted rates of its group."""
    found = []
    for lang, source, text in rows:
        n, chars, symbols, dup, repeats = brute(text)
        over = {"word_length": chars, "symbols": symbols, "dup_lines": dup, "repeats": repeats}
        base = n < 20 or 100 * repeats > 30 * n
        found.append((lang, source, n, base, {r: v * 1_000_000 // n if n else 0 for r, v in over.items()}))
    out = []
    for lang, source, n, base, rates in found:
        good = [f for f in found if not f[3]]
        for group in ([f for f in good if f[:2] == (lang, source)], [f for f in good if f[0] == lang], good):
            if len(group) >= q.MIN_GROUP:
                break
        length = _bounds([f[2] for f in group], 0.5)[1]
        reasons = []
        for r, (_, words) in q.RATES.items():
            values = [f[4][r] for f in group]
            low, mid, high = _bounds(values, 0.1)[0], _bounds(values, 0.5), _bounds(values, 0.9)[1]
            most = high + q.REACH * max(high - mid[0], words * 1_000_000 / length)
            least = low - q.REACH * max(mid[1] - low, 0) if r == "word_length" else 0
            if not least <= rates[r] <= most:
                reasons.append(r)
        out.append((base, not base and not reasons, reasons))
    return out


def test_registered_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: (r.lang, r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = dict(zip(docs, brute_kept(list(docs.values()))))
    got = {r.doc_id: (r.base_failed, r.kept, list(r.reasons)) for r in op4_quality(spark, sf).collect()}
    assert got == want
    assert 0.5 < sum(w[1] for w in want.values()) / len(want) < 1 and any("symbols" in w[2] for w in want.values())


def test_extra_columns_keep_their_values(odd):
    for name in ("symbols", "limits", "dup_lines", "rate", "n", "length", "word_length", "x", "bin"):
        rows = q.quality(odd(name)).collect()
        assert len(rows) == 12 and {r[name] for r in rows} == {7}


def test_sketch_merges(spark, odd):
    rates = q.with_rates(q.features(odd("x")).withColumn("base_failed", F.lit(False)))
    whole = q.sketches(rates, []).sort("rate", "bin").collect()
    parts = q.sketches(rates, ["lang", "source"]).groupBy("rate", "bin").agg(F.sum("n").alias("n")).sort("rate", "bin").collect()
    assert whole == parts


def test_awkward_rows(spark, odd):
    rows = q.quality(odd("kept"))
    assert rows.count() == 12 and rows.columns.count("kept") == 1 and "other" in rows.columns
    assert rows.where("text is null").first().base_failed
    assert q.quality(odd("kept", rows=[])).count() == 0
