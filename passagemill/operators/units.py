"""Structural units of a document, as an array on the document's own row.

Keeping the units on the row is what makes chunking shuffle-free: a document is
never gathered again after it was taken apart.

A unit is ``struct<brk boolean, kind string, heading string, text string>``;
``brk`` marks the first unit of a section, where no chunk may run across.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse, not_blank

UNIT = "struct<brk:boolean,kind:string,heading:string,text:string>"

# ---- fixed values: HTML tags and character references --------------------------
HEADING_TAGS = "title|h[1-6]"
BLOCK_TAGS = "p|li|tr|pre|blockquote|caption|dt|dd"
OTHER_BLOCKS = (
    "div|nav|ul|ol|dl|table|thead|tbody|article|section|header|footer|main|aside|form|figure|head|body|html"
)
#: Where a reference isn't read as its character.
READ_AS = {"nbsp;": " "}
# --------------------------------------------------------------------------------

# Markers that cannot occur in text: section start, end of tag name, unit start.
SECTION, NAME_END, UNIT_START = "\x01", "\x02", "\x03"


def html_markers() -> list[tuple[str, str]]:
    """Ordered (pattern, replacement) pairs that turn markup into markers.

    ``{1}`` stands for the first group. The patterns stay in the subset that
    Java's and RE2's engines read the same way.
    """
    return [
        ("[\x01\x02\x03]", ""),
        (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", ""),
        (rf"(?i)<({HEADING_TAGS})(?:\s[^>]*)?>", f"{SECTION}{{1}}{NAME_END}"),
        (rf"(?i)<({BLOCK_TAGS})(?:\s[^>]*)?>", f"{UNIT_START}{{1}}{NAME_END}"),
        (
            rf"(?i)</?(?:{HEADING_TAGS}|{BLOCK_TAGS}|{OTHER_BLOCKS})(?:\s[^>]*)?>",
            f"{UNIT_START}{NAME_END}",
        ),
        (r"(?i)<br\s*/?>|</?t[dh](?:\s[^>]*)?>", " "),
        (r"<[a-zA-Z/!][^>]*(?:>|$)", ""),
    ]


_NAMES = {k: v for k, v in html5.items() if k.endswith(";")} | READ_AS


def decode_references(text: Column) -> Column:
    """Character references by name (the public HTML table) and by number, in one pass.

    What isn't a reference stays as it is; numbers that aren't characters become U+FFFD.
    """
    # two constants, not thousands of literals in each copy of the expression
    names = [F.split(F.lit(UNIT_START.join(x)), UNIT_START) for x in (_NAMES, _NAMES.values())]

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, "^[A-Za-z][A-Za-z0-9]*;", 0)
        at = F.array_position(names[0], name)
        number = F.regexp_extract(p, "^#(?:[xX][0-9a-fA-F]{1,7}|[0-9]{1,8});", 0)
        digits = F.regexp_extract(number, "[0-9a-fA-F]+", 0)
        is_hex = F.lower(F.substring(number, 2, 1)) == "x"
        code = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long")
        bad = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(~bad, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return (
            F.when(at > 0, F.concat(F.try_element_at(names[1], at.cast("int")), F.substr(p, F.length(name) + 1)))
            .when(F.length(number) > 0, F.concat(char, F.substr(p, F.length(number) + 1)))
            .otherwise(F.concat(F.lit("&"), p))
        )

    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), piece)
    return F.when(F.contains(text, F.lit("&")), F.concat(F.element_at(parts, 1), F.array_join(rest, ""))).otherwise(text)


def clean_text(text: Column) -> Column:
    return collapse(decode_references(text))


def line_units(df: DataFrame, text: str, out: str = "units") -> DataFrame:
    """Each non-blank line, white space collapsed, is a unit of one section."""
    lines = F.filter(F.split(F.col(text), "\n"), not_blank)
    return df.withColumn(
        out,
        F.transform(
            lines,
            lambda x: F.struct(
                F.lit(False).alias("brk"),
                F.lit("line").alias("kind"),
                F.lit("").alias("heading"),
                collapse(x).alias("text"),
            ),
        ),
    )


def html_units(df: DataFrame, html: str, out: str = "units") -> DataFrame:
    """Titles, headings, paragraphs, list items, table rows and loose text.

    A heading opens a section; all units below carry its text as ``heading``.
    """
    marked = F.col(html)
    for pattern, replacement in html_markers():
        marked = F.regexp_replace(marked, pattern, replacement.replace("{1}", "$1"))
    marked = F.concat(F.lit(NAME_END), marked)

    def unit(piece: Column) -> Column:
        parts = F.split(piece, NAME_END)
        name = F.lower(F.element_at(parts, 1))
        return F.struct(
            F.when(name == "", "text").otherwise(name).alias("kind"),
            clean_text(F.try_element_at(parts, F.lit(2))).alias("text"),
        )

    sections = F.transform(
        F.split(marked, SECTION), lambda s: F.transform(F.split(s, UNIT_START), unit)
    )

    def section_units(section: Column, i: Column) -> Column:
        heading = F.when(i > 0, F.element_at(section, 1)["text"]).otherwise("")
        return F.transform(
            F.filter(section, lambda u: u["text"] != ""),
            lambda u, j: F.struct(
                ((i > 0) & (j == 0)).alias("brk"),
                u["kind"].alias("kind"),
                heading.alias("heading"),
                u["text"].alias("text"),
            ),
        )

    return (
        df.withColumn("__sections", sections)
        .withColumn(out, F.flatten(F.transform("__sections", section_units)))
        .drop("__sections")
    )


def explode_units(df: DataFrame, keys: list[str], units: str = "units") -> DataFrame:
    """One row per unit: keys, unit_no, kind, heading, text."""
    return df.select(*keys, F.posexplode(units).alias("unit_no", "u")).select(
        *keys,
        F.col("unit_no").cast("long"),
        F.col("u.kind").alias("kind"),
        F.col("u.heading").alias("heading"),
        F.col("u.text").alias("text"),
    )
