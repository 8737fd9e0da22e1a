"""Chunks that know where they stand: the whole path of headings, and the header of the table they were cut from.

Everything stays on the document's row, like the units of :mod:`.units`. A fold over the headings keeps a stack: a
heading takes off all of its own level and deeper ones and is put on top, and the stack is the path of
what follows (title > h1 > h2 ...). A table's leading rows of header cells only are its header; where a
chunk begins inside the table's body, the header is put before it and counts towards the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CHUNK_TOKENS
from ..functions.text import not_blank
from .units import NAME_END, SECTION, UNIT_START, clean_text, html_markers

HEADER_CELL, BODY_CELL = "\x04", "\x05"
#: Printed between the headings of a path.
PATH_SEPARATOR = " > "
#: Headings, or pieces, that one step of a fold copies.
_PAGE = 256

#: Marks of tables and cells, set before those of the units.
_TABLE_MARKERS = [
    (f"[{HEADER_CELL}{BODY_CELL}]", ""),
    (r"(?i)<table(?:\s[^>]*)?>", f"{UNIT_START}table{NAME_END}"),
    (r"(?i)</table\s*>", f"{UNIT_START}/table{NAME_END}"),
    (r"(?i)<th(?:\s[^>]*)?>", f" {HEADER_CELL}"),
    (r"(?i)<td(?:\s[^>]*)?>", f" {BODY_CELL}"),
]


def _folded(items: str, state: str, kinds: str, out: str, step: str) -> str:
    """A fold over the array ``items`` that gives one value an item.

    ``state`` starts it (a struct's expression) and ``step`` makes of ``a.state`` and the item ``x`` a struct (state, out). Spark
    copies a fold's state at each step, so results are collected page by page.
    """
    return f"""IF(size({items}) = 0, CAST(array() AS ARRAY<{out}>),
  aggregate(
    transform(sequence(0, CAST(floor((size({items}) - 1) / {_PAGE}) AS INT)), i -> slice({items}, i * {_PAGE} + 1, {_PAGE})),
    named_struct('state', {state}, 'out', CAST(array() AS ARRAY<ARRAY<{out}>>)),
    (acc, page) -> element_at(transform(
      array(aggregate(page, named_struct('state', acc.state, 'out', CAST(array() AS ARRAY<{out}>)),
        (a, x) -> element_at(transform(array({step}),
          r -> named_struct('state', CAST(r.state AS {kinds}), 'out', concat(a.out, array(r.out)))), 1))),
      d -> named_struct('state', d.state, 'out', concat(acc.out, array(d.out)))), 1),
    acc -> flatten(acc.out)))"""


_STACK = "ARRAY<STRUCT<level: INT, text: STRING>>"
_PATHS = _folded(
    "__heads",
    f"CAST(array() AS {_STACK})",
    _STACK,
    "ARRAY<STRING>",
    """element_at(transform(array(IF(x.level < 0, a.state, concat(filter(a.state, s -> s.level < x.level), array(x)))),
      st -> named_struct('state', st, 'out', transform(filter(st, s -> s.text <> ''), s -> s.text))), 1)""",
)
# header rows so far of the table that a unit stands in: none outside, complete once a body row was seen
_TABLE = "STRUCT<inside: BOOLEAN, open: BOOLEAN, rows: ARRAY<STRING>>"
_HEADERS = _folded(
    "__raw",
    "named_struct('inside', false, 'open', false, 'rows', CAST(array() AS ARRAY<STRING>))",
    _TABLE,
    "STRUCT<header: STRING, is_header: BOOLEAN>",
    """CASE
      WHEN x.kind = 'table' THEN named_struct('state', named_struct('inside', true, 'open', true, 'rows', CAST(array() AS ARRAY<STRING>)),
        'out', named_struct('header', '', 'is_header', false))
      WHEN x.kind = '/table' OR x.first THEN named_struct('state', named_struct('inside', false, 'open', false, 'rows', CAST(array() AS ARRAY<STRING>)),
        'out', named_struct('header', '', 'is_header', false))
      WHEN x.kind = 'tr' AND x.text <> '' AND a.state.open AND x.heads THEN named_struct(
        'state', named_struct('inside', true, 'open', true, 'rows', concat(a.state.rows, array(x.text))), 'out', named_struct('header', '', 'is_header', true))
      WHEN x.kind = 'tr' AND x.text <> '' AND a.state.inside THEN named_struct(
        'state', named_struct('inside', true, 'open', false, 'rows', a.state.rows),
        'out', named_struct('header', array_join(a.state.rows, '\\n'), 'is_header', false))
      ELSE named_struct('state', a.state, 'out', named_struct('header', '', 'is_header', false)) END""",
)


def section_units(df: DataFrame, html: str, out: str = "units") -> DataFrame:
    """Units of a page as ``array<struct<brk, kind, path, header, text>>``.

    ``path``: the headings above, outermost first, the unit's own section included; ``header``: of a
    table's body row, the header rows of its table, one a line. Blank units are left out.
    """
    marked = F.col(html)
    first, *others = html_markers()
    for pattern, replacement in [first, *_comments(others), *_TABLE_MARKERS, *_others(others)]:
        marked = F.regexp_replace(marked, pattern, replacement.replace("{1}", "$1"))
    marked = F.concat(F.lit(NAME_END), marked)

    def unit(piece: Column) -> Column:
        parts = F.split(piece, NAME_END)
        body = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
        return F.struct(
            F.lower(F.element_at(parts, 1)).alias("kind"),
            (F.contains(body, F.lit(HEADER_CELL)) & ~F.contains(body, F.lit(BODY_CELL))).alias("heads"),
            clean_text(F.translate(body, HEADER_CELL + BODY_CELL, "")).alias("text"),
        )

    sections = F.transform(F.split(marked, SECTION), lambda s: F.transform(F.split(s, UNIT_START), unit))
    # what stands before the first heading has none: level -1
    level = lambda k: F.when(k == "title", 0).otherwise(F.substring(k, 2, 1).cast("int"))
    heads = F.transform(
        "__sections",
        lambda s, i: F.struct(F.when(i == 0, -1).otherwise(level(s[0]["kind"])).cast("int").alias("level"), F.when(i == 0, "").otherwise(s[0]["text"]).alias("text")),
    )
    # the first of each section is marked, so that an unclosed table ends there
    raw = F.flatten(
        F.transform(
            "__sections",
            lambda s, i: F.transform(
                s,
                lambda u, j: F.struct(
                    ((i > 0) & (j == 0)).alias("first"), i.alias("section"), u["kind"].alias("kind"), u["heads"].alias("heads"), u["text"].alias("text")
                ),
            ),
        )
    )
    joined = F.zip_with(
        "__raw",
        "__headers",
        lambda u, h: F.struct(
            u["section"].alias("section"),
            F.when(u["kind"] == "", "text").otherwise(u["kind"]).alias("kind"),
            F.element_at("__paths", u["section"] + 1).alias("path"),
            h["header"].alias("header"),
            u["text"].alias("text"),
        ),
    )
    inked = F.filter(joined, lambda u: u["text"] != "")
    units = F.transform(
        F.array(inked),
        lambda us: F.transform(
            us,
            lambda u, i: F.struct(
                ((u["section"] > 0) & (F.when(i == 0, -1).otherwise(F.try_element_at(us, i)["section"]) != u["section"])).alias("brk"),
                u["kind"].alias("kind"), u["path"].alias("path"), u["header"].alias("header"), u["text"].alias("text"),
            ),
        ),
    )
    return (
        df.withColumn("__sections", sections)
        .withColumn("__heads", heads)
        .withColumn("__raw", raw)
        .withColumn("__paths", F.expr(_PATHS))
        .withColumn("__headers", F.expr(_HEADERS))
        .withColumn(out, F.element_at(units, 1))
        .drop("__sections", "__heads", "__raw", "__paths", "__headers")
    )


def _is_comment(pattern: str) -> bool:
    return "<!--" in pattern


def _comments(markers: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """What takes out comments, scripts and styles; it comes before the marks of tables."""
    return [m for m in markers if _is_comment(m[0])]


def _others(markers: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [m for m in markers if not _is_comment(m[0])]


# a body row's header is repeated if it leaves at least half of the bound for the row
_COUNTED = """transform(filter({units}, u -> u.text <> ''), u -> element_at(transform(
  array(CAST(IF(u.header = '', 0, length(u.header) - length(regexp_replace(u.header, '[ \\n]', '')) + 1) AS BIGINT)),
  h -> named_struct('brk', u.brk, 'path', u.path, 'header', IF(h * 2 > {cap}, '', u.header), 'hn', IF(h * 2 > {cap}, 0L, h),
    'n', CAST(length(u.text) - length(replace(u.text, ' ', '')) + 1 AS BIGINT), 'text', u.text)), 1))"""

_PIECES = """flatten(transform(__counted, u -> IF(u.n <= {cap} - u.hn, array(u),
  flatten(transform(array(split(u.text, ' ')), ws ->
    transform(sequence(0, CAST(floor((size(ws) - 1) / ({cap} - u.hn)) AS INT)), i -> named_struct(
      'brk', u.brk AND i = 0, 'path', u.path, 'header', u.header, 'hn', u.hn,
      'n', CAST(least({cap} - u.hn, size(ws) - i * ({cap} - u.hn)) AS BIGINT),
      'text', array_join(slice(ws, CAST(i * ({cap} - u.hn) + 1 AS INT), CAST({cap} - u.hn AS INT)), ' '))))))))"""

# whether each piece starts a chunk; the state is what the chunk holds so far
_FRESH = _folded(
    "__sizes",
    "-1L",
    "BIGINT",
    "BOOLEAN",
    """IF(a.state < 0 OR x.brk OR a.state + x.n > {cap},
      named_struct('state', x.hn + x.n, 'out', true), named_struct('state', a.state + x.n, 'out', false))""",
)

_CHUNKS = """transform(__starts, (s, i) -> named_struct(
  'path', element_at(__pieces, s + 1).path,
  'text', concat(IF(element_at(__pieces, s + 1).hn > 0, concat(element_at(__pieces, s + 1).header, '\\n'), ''),
    array_join(transform(slice(__pieces, s + 1, coalesce(try_element_at(__starts, i + 2), size(__pieces)) - s), p -> p.text), '\\n'))))"""


def section_chunks(df: DataFrame, units: str = "units", cap: int = CHUNK_TOKENS, out: str = "chunks") -> DataFrame:
    """Pack units of one section while their words stay within ``cap``: ``array<struct<path, text>>``.

    A unit over the bound is cut. A chunk that begins with a row of a table's body begins with the
    table's header, unless that is more than half of the bound.
    """
    starts = F.filter(F.transform("__fresh", lambda f, i: F.when(f, i)), lambda i: i.isNotNull())
    return (
        df.withColumn("__counted", F.expr(_COUNTED.format(units=units, cap=cap)))
        .withColumn("__pieces", F.expr(_PIECES.format(cap=cap)))
        .withColumn("__sizes", F.transform("__pieces", lambda p: F.struct(p["brk"].alias("brk"), p["hn"].alias("hn"), p["n"].alias("n"))))
        .withColumn("__fresh", F.expr(_FRESH.replace("{cap}", str(cap))))
        .withColumn("__starts", starts)
        .withColumn(out, F.expr(_CHUNKS))
        .drop("__counted", "__pieces", "__sizes", "__fresh", "__starts")
    )


def explode_section_chunks(df: DataFrame, keys: list[str], chunks: str = "chunks") -> DataFrame:
    """One row a chunk: keys, chunk_index, section_path, text."""
    # exploding an expression, not the column: a filter on its size would be pushed down, and all of the chunking repeated in it
    numbered = F.transform(
        chunks, lambda c, i: F.struct(i.cast("long").alias("chunk_index"), F.array_join(c["path"], PATH_SEPARATOR).alias("section_path"), c["text"].alias("text"))
    )
    return df.select(*keys, F.explode(numbered).alias("c")).select(*keys, "c.chunk_index", "c.section_path", "c.text")


def with_path(path: Column, text: Column) -> Column:
    """What is embedded of a chunk: its path as a line before its text."""
    return F.when(not_blank(path), F.concat(path, F.lit("\n"), text)).otherwise(text)
