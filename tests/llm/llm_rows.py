import pytest

ODD = [
    # id, text, lang, source, and columns with the names of results
    (1, None, None, None, 7, "a"),
    (2, "", "en", "s1", 7, "a"),
    (3, " \t\n ", "en", None, 7, "a"),
    (4, "one", "en", "s2", 7, "b"),
    (4, "one", "en", "s2", 7, "b"),
    (5, "One, two; three!\nOne, two; three!\n" * 3, "fr", "s2", 7, "b"),
    (6, "Éa ñandú 漢字 ́x \U0001f600 <|startoftext|> it's 3.5% #a | b", None, "s1", 7, "c"),
    (7, "word " * 30_000, "de", "é", 7, "c"),
    (8, "x" * 200_000, "de", "z", 7, "c"),
    (None, "no id here", "en", "s1", 7, "d"),
    (None, "no id here", "en", "s1", 7, "d"),
    (9, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu", "en", "s1", 7, "d"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, {clash} int, other string"


@pytest.fixture()
def odd(spark, tmp_path):
    """Awkward rows as a stored table, with a column that clashes with a result's name."""

    def make(clash="score", rows=ODD, parts=3):
        path = str(tmp_path / f"odd-{clash}-{len(rows)}")
        spark.createDataFrame(rows, SCHEMA.format(clash=clash)).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return make
