import random

import pytest
from pyspark.sql import functions as F

from passagemill.operators.chunking import explode_chunks, greedy_chunks, numbered, token_windows, tokenizer_count
from passagemill.operators.units import explode_units, html_units, line_units


def greedy(units, cap):
    """Plain statement of the packing rule: units are (brk, text)."""
    pieces = []
    for brk, text in units:
        if not text.strip():
            continue
        w = text.split()
        if len(w) <= cap:
            pieces.append((brk, len(w), text))
        else:
            for i in range(0, len(w), cap):
                part = w[i : i + cap]
                pieces.append((brk and i == 0, len(part), " ".join(part)))
    out, held = [], 0
    for brk, n, text in pieces:
        if not out or brk or held + n > cap:
            out.append([text])
            held = n
        else:
            out[-1].append(text)
            held += n
    return ["\n".join(c) for c in out]


def packed(spark, docs, cap, collapsed=False):
    rows = [(i, [(b, "text", "", t) for b, t in units]) for i, units in enumerate(docs)]
    df = spark.createDataFrame(
        rows, "doc long, units array<struct<brk:boolean,kind:string,heading:string,text:string>>"
    )
    got = greedy_chunks(df, cap=cap, collapsed=collapsed).orderBy("doc").collect()
    return [r["chunks"] for r in got]


@pytest.mark.parametrize("cap", [1, 3, 8])
@pytest.mark.parametrize("collapsed", [False, True])
def test_packing_against_brute_force(spark, cap, collapsed):
    rng = random.Random(cap)
    docs = [
        [
            (rng.random() < 0.2, " ".join(rng.choice("abc") * rng.randint(1, 4) for _ in range(rng.choice([0, 1, 2, 3, 7, 20]))))
            for _ in range(rng.randint(0, 12))
        ]
        for _ in range(60)
    ]
    got = packed(spark, docs, cap, collapsed)
    assert got == [greedy(d, cap) for d in docs]
    for chunks, units in zip(got, docs):
        assert all(len(c.split()) <= cap for c in chunks)
        assert " ".join(chunks).split() == [w for _, t in units for w in t.split()]


def test_uncollapsed_units_count_tokens(spark):
    assert packed(spark, [[(False, "a\n b"), (False, "c\td")]], 3) == [["a\n b", "c\td"]]


def test_exact_cap_and_one_more(spark):
    at, over = " ".join(["w"] * 256), " ".join(["w"] * 257)
    got = packed(spark, [[(False, at)], [(False, over)]], 256)
    assert [len(c) for c in got] == [1, 2]
    assert got[1][1] == "w"


def test_many_units_against_brute_force(spark):
    rng = random.Random(1)
    docs = [
        [(rng.random() < 0.02, " ".join(["w"] * rng.choice([1, 2, 5, 9, 30]))) for _ in range(n)]
        for n in (255, 256, 257, 512, 513, 3000)
    ]
    assert packed(spark, docs, 20) == [greedy(d, 20) for d in docs]


def test_very_long_document(spark):
    text = " ".join(f"w{i}" for i in range(200_000))
    got = packed(spark, [[(False, text)]], 256)[0]
    assert len(got) == -(-200_000 // 256)
    assert " ".join(got) == text


def test_windows(spark):
    df = spark.createDataFrame([(0, " ".join("abcdefg")), (1, "  "), (2, "x")], "doc long, text string")
    got = {r["doc"]: r["chunks"] for r in token_windows(df, "text", 3).collect()}
    assert got == {0: ["a b c", "d e f", "g"], 1: [], 2: ["x"]}


def test_index_modes(spark):
    df = spark.createDataFrame([(1, ["a", " \n", "b"])], "doc long, chunks array<string>")
    assert [(r[1], r[2]) for r in explode_chunks(df, ["doc"]).collect()] == [(0, "a"), (2, "b")]
    assert [(r[1], r[2]) for r in explode_chunks(df, ["doc"], index_mode="dense").collect()] == [(0, "a"), (1, "b")]
    with pytest.raises(ValueError):
        numbered(F.col("chunks"), "other")


def test_html_units_and_sections(spark):
    html = (
        "<html><head><title>T &amp; U</title><script>var p='<p>no</p>'</script></head><body>loose"
        "<h1>First</h1><p>one<br>two <b>bold</b><p>unclosed<ul><li>item</li></ul>"
        "<h2 class='x'>Second</h2><table><tr><td>a</td><td>b</td></tr></table><!-- <p>gone</p> --><div>tail &lt;x&gt;</div>"
    )
    df = html_units(spark.createDataFrame([(1, html)], "page long, html string"), "html")
    got = [(r["kind"], r["heading"], r["text"]) for r in explode_units(df, ["page"]).orderBy("unit_no").collect()]
    assert got == [
        ("title", "T & U", "T & U"), ("text", "T & U", "loose"), ("h1", "First", "First"),
        ("p", "First", "one two bold"), ("p", "First", "unclosed"), ("li", "First", "item"),
        ("h2", "Second", "Second"), ("tr", "Second", "a b"), ("text", "Second", "tail <x>"),
    ]
    chunks = [r["text"] for r in explode_chunks(greedy_chunks(df), ["page"]).orderBy("chunk_index").collect()]
    assert chunks == ["T & U\nloose", "First\none two bold\nunclosed\nitem", "Second\na b\ntail <x>"]


def test_line_units_skip_blanks(spark):
    df = line_units(spark.createDataFrame([(1, "a  b\n \n \nc")], "d long, text string"), "text")
    assert [r["text"] for r in explode_units(df, ["d"]).orderBy("unit_no").collect()] == ["a b", "c"]


def make_subword_tokenizer():
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tokenizer = Tokenizer(models.BPE())
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    tokenizer.train_from_iterator(["the cat sat on the mat, été"], trainers.BpeTrainer(vocab_size=30, show_progress=False))
    return lambda text: tokenizer.encode(text).offsets


def test_packing_with_a_subword_tokenizer(spark):
    pytest.importorskip("tokenizers")
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    tokenize = make_subword_tokenizer()
    text = "the cat sat on the mat, été " * 9
    rows = [(1, [(False, "p", "", text.strip()), (False, "p", "", "the cat"), (False, "p", "", "!!")])]
    df = spark.createDataFrame(rows, "doc long, units array<struct<brk:boolean,kind:string,heading:string,text:string>>")
    chunks = greedy_chunks(df, cap=10, make_tokenizer=make_subword_tokenizer).head()["chunks"]
    assert all(len(tokenize(c)) <= 10 for c in chunks)
    assert " ".join(chunks).replace(" ", "").replace("\n", "") == (text + "the cat!!").replace(" ", "")
    got = df.select(tokenizer_count(F.col("units")[0]["text"], make_subword_tokenizer)).head()[0]
    assert got == len(tokenize(text))
