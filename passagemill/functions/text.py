"""String expressions shared by all stages. Everything here is a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.strip() sees it.
_STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_HAS_INK = r"(?U)[^\s\x1c-\x1f]"


def not_blank(text: Column) -> Column:
    """True if anything remains after stripping white space."""
    return text.rlike(_HAS_INK)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _STRIP, "")


def collapse(text: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def words(text: Column) -> Column:
    """White-space separated words; an empty array for blank text."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def token_count(text: Column, collapsed: bool = False) -> Column:
    """Number of white-space separated tokens.

    Text known to be collapsed, and not blank, has one space between tokens; then
    counting the spaces is enough.
    """
    if collapsed:
        return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long")
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot does not start one."""
    return F.regexp_extract(base_name(path), r"(?s)^(.+?)(\.[^.]*)?$", 1)


def preview(text: Column, n: int = 200, tail: str = "...") -> Column:
    return F.concat(F.substring(text, 1, n), F.lit(tail))


def short_error(error: Column, n: int) -> Column:
    return F.left(error, F.lit(n))


def service_name(model: Column) -> Column:
    """``org/Some_Model_v0.3`` -> ``some-model-v0-3``."""
    return F.translate(F.lower(base_name(model)), "_.", "--")


def cache_name(model: Column) -> Column:
    """``org/model`` -> ``org--model``."""
    return F.replace(model, F.lit("/"), F.lit("--"))


def fixed3(x: Column) -> Column:
    """A number in [-1000, 1000] with three decimals, correctly rounded.

    ``format_string('%.3f')`` rounds the shortest decimal form half up; scores
    are shown the way C and Python print them, from the exact binary value with
    ties to even. ``y`` is split in two halves whose products with 1000 carry no
    rounding error, so the comparison with one half is exact.
    """
    y = F.abs(x.cast("double"))
    high = F.floor(y * F.lit(67108864.0)).cast("double") / F.lit(67108864.0)  # 2^26
    n = F.floor(y * F.lit(1000.0))
    over = (high * 1000.0 - n.cast("double") - 0.5) + (y - high) * 1000.0
    n = n + F.when(over > 0, 1).when(over == 0, n % 2).otherwise(0)
    sign = F.when(x < 0, "-").otherwise("")
    return F.when(
        x.isNotNull(),
        F.concat(sign, F.floor(n / 1000).cast("string"), F.lit("."), F.lpad((n % 1000).cast("string"), 3, "0")),
    )
