import re

import pytest

from passagemill.operators import sections as s

PAGE = """<html><head><title>Guide</title></head><body><p>intro</p>
<h1>One</h1><p>first</p><h2>One A</h2><p>deep</p><h3>One A i</h3><p>deeper</p><h2>One B</h2><p>back</p>
<h3></h3><p>under a blank heading</p>
<h1>Two</h1><table><caption>sizes</caption><thead><tr><th>name</th><th>size</th></tr></thead>
<tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr><tr><th>c</th><td>3</td></tr></table><p>after</p>
<table><tr><td>no</td><td>header</td></tr><tr><th>late</th><th>header</th></tr></table></body></html>"""


def units_of(spark, html):
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    return s.section_units(df, "html").first()["units"]


def chunks_of(spark, html, cap):
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    return [(list(c["path"]), c["text"]) for c in s.section_chunks(s.section_units(df, "html"), cap=cap).first()["chunks"]]


def test_paths_are_stacks_of_headings(spark):
    found = {u["text"]: list(u["path"]) for u in units_of(spark, PAGE)}
    assert found["intro"] == ["Guide"]
    assert found["first"] == ["Guide", "One"]
    assert found["deep"] == found["One A"] == ["Guide", "One", "One A"]
    assert found["deeper"] == ["Guide", "One", "One A", "One A i"]
    assert found["back"] == found["under a blank heading"] == ["Guide", "One", "One B"]
    assert found["after"] == ["Guide", "Two"]


def test_only_leading_rows_of_header_cells_are_a_header(spark):
    found = {u["text"]: u["header"] for u in units_of(spark, PAGE)}
    assert found["name size"] == "" and found["sizes"] == "" and found["after"] == ""
    assert found["a 1"] == found["b 2"] == found["c 3"] == "name size"
    assert found["no header"] == found["late header"] == ""


def test_header_is_repeated_where_a_chunk_begins_in_a_table(spark):
    rows = "".join(f"<tr><td>r{i}</td><td>v{i}</td></tr>" for i in range(7))
    html = f"<h1>T</h1><table><tr><th>name</th><th>value</th></tr>{rows}</table><p>end</p>"
    chunks = chunks_of(spark, html, 8)
    assert chunks[0] == (["T"], "T\nname value\nr0 v0\nr1 v1")
    assert chunks[1] == (["T"], "name value\nr2 v2\nr3 v3\nr4 v4")
    assert chunks[2] == (["T"], "name value\nr5 v5\nr6 v6\nend"[: len("name value\nr5 v5\nr6 v6\nend")])
    assert all(len(t.split()) <= 8 for _, t in chunks)


def test_long_rows_are_cut_with_their_header_and_long_headers_are_not_repeated(spark):
    row = " ".join(f"w{i}" for i in range(20))
    chunks = chunks_of(spark, f"<table><tr><th>h1</th><th>h2</th></tr><tr><td>{row}</td></tr></table>", 8)
    assert [t.split("\n")[0] for _, t in chunks[1:]] == ["h1 h2"] * (len(chunks) - 1) and len(chunks) > 3
    assert " ".join(re.findall(r"w\d+", " ".join(t for _, t in chunks))) == row
    wide = "".join(f"<th>h{i}</th>" for i in range(6))
    chunks = chunks_of(spark, f"<table><tr>{wide}</tr><tr><td>a</td></tr><tr><td>{row}</td></tr></table>", 8)
    assert sum("h0" in t for _, t in chunks) == 1 and all(len(t.split()) <= 8 for _, t in chunks)


def test_chunks_stay_within_a_section(spark):
    chunks = chunks_of(spark, PAGE, 100)
    assert [c[0][-1] if c[0] else "" for c in chunks] == ["Guide", "One", "One A", "One A i", "One B", "One B", "Two"]


def brute_paths(levels):
    stack, out = [], []
    for i, level in enumerate(levels):
        while stack and stack[-1][0] >= level:
            stack.pop()
        stack.append((level, f"H{i}"))
        out.append([t for _, t in stack])
    return out


@pytest.mark.parametrize("n", [3, 700])  # more headings than a page of the fold holds
def test_many_headings_and_odd_pages(spark, n):
    levels = [1 + (i * i * 7 + i // 3) % 6 for i in range(n)]
    html = "".join(f"<h{v}>H{i}</h{v}><p>p{i}</p>" for i, v in enumerate(levels))
    found = {u["text"]: list(u["path"]) for u in units_of(spark, html)}
    want = brute_paths(levels)
    assert all(found[f"p{i}"] == want[i] for i in range(n))


def test_no_page_no_text_no_headings(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p> </p>"), (4, "plain"), (5, "<td>loose</td><table><tr><th>x"), (6, "a\x01\x04b")], "page_id int, html string")
    rows = s.explode_section_chunks(s.section_chunks(s.section_units(df, "html")), ["page_id"]).collect()
    assert {(r.page_id, r.section_path, r.text) for r in rows} == {(4, "", "plain"), (5, "", "loose\nx"), (6, "", "ab")}
    out = df.select(s.with_path(df.html, df.html).alias("t")).collect()
    assert out[3].t == "plain\nplain"


def test_a_long_table(spark):
    rows = "".join(f"<tr><td>r{i}</td></tr>" for i in range(900))
    chunks = chunks_of(spark, f"<table><tr><th>head</th></tr>{rows}</table>", 10)
    assert len(chunks) == 100 and all(t.startswith("head\n") for _, t in chunks)
