import os.path
import random

from pyspark.sql import functions as F

from passagemill.functions.status import known_status, stored_error
from passagemill.functions.text import (
    cache_name, collapse, fixed3, not_blank, preview, service_name, short_error, stem, base_name, strip, token_count, words,
)


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, x {kind}")
    return [r[1] for r in df.select("i", expression(F.col("x"))).orderBy("i").collect()]


def test_blank_and_strip_agree_with_python(spark):
    texts = ["", " ", "\n\t ", " ", " x ", " a ", "\x1c\x1f", " ", "a​", "0", "　b\x1c"]
    assert column(spark, texts, not_blank) == [bool(t.strip()) for t in texts]
    assert column(spark, texts, strip) == [t.strip() for t in texts]


def test_fixed3_agrees_with_python(spark):
    rng = random.Random(7)
    numbers = [0.0625, 0.1235, 0.0005, 0.0015, 0.1245, -0.1235, 0.9995, 1.0, -1.0, 0.0, 0.99949999, 0.5, 0.0004999]
    numbers += [i / 2000 for i in range(-2000, 2001)]
    numbers += [rng.uniform(-1, 1) for _ in range(3000)] + [rng.uniform(-0.01, 0.01) for _ in range(1000)]
    assert column(spark, numbers, fixed3, "double") == [f"{x:.3f}" for x in numbers]
    assert column(spark, [None], fixed3, "double") == [None]


def test_path_parts_agree_with_python(spark):
    paths = ["a/x.tar.gz", "/d/.bashrc", "a.pdf", "noext", "p/q.d/r", "x.", "a/b/", ".a.b"]
    assert column(spark, paths, base_name) == [os.path.basename(p) for p in paths]
    assert column(spark, paths, stem) == [os.path.splitext(os.path.basename(p))[0] for p in paths]


def test_words_and_counts(spark):
    texts = ["", "  ", "a", " a  b\n\tc ", "x\ny"]
    assert column(spark, texts, words) == [t.split() for t in texts]
    assert column(spark, texts, token_count) == [len(t.split()) for t in texts]
    assert column(spark, texts, collapse) == [" ".join(t.split()) for t in texts]
    full = [t for t in texts if t.strip()]
    assert column(spark, full, lambda c: token_count(collapse(c), True)) == [len(t.split()) for t in full]


def test_names_previews_errors(spark):
    assert column(spark, ["org/Some_Model_v0.3"], service_name) == ["some-model-v0-3"]
    assert column(spark, ["org/model"], cache_name) == ["org--model"]
    assert column(spark, ["x" * 300, "ab"], preview) == ["x" * 200 + "...", "ab..."]
    assert column(spark, ["e" * 500], stored_error) == ["e" * 200]
    assert column(spark, [None], stored_error) == [""]
    assert column(spark, ["e" * 500], lambda c: short_error(c, 80)) == ["e" * 80]
    assert column(spark, ["success", "empty", "timeout", "error", "weird", None], known_status) == [
        "success", "empty", "timeout", "error", "error", "error",
    ]
