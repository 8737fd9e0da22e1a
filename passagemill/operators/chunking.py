"""Token-bounded chunks. All of it works on one document's row, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CHUNK_TOKENS
from ..functions.text import not_blank, token_count, words


_PAGE = 256

#: Builds a tokenizer: text -> list of (start, end) character positions of its tokens.
#: It runs once per task.
MakeTokenizer = Callable[[], Callable[[str], list[tuple[int, int]]]]

_SPAN = pa.struct([("n", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def token_spans(texts: Column, make_tokenizer: MakeTokenizer, cap: int) -> Column:
    """For each text of an array, the windows of at most ``cap`` tokens it is cut
    into: ``array<array<struct<n, start, end>>>``. A text without tokens is one
    window of none."""

    @F.arrow_udf("array<array<struct<n:long,start:int,end:int>>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenize = make_tokenizer()

        def windows(text: str) -> list[dict]:
            spans = tokenize(text)
            if not spans:
                return [{"n": 0, "start": 0, "end": len(text)}]
            parts = [spans[i : i + cap] for i in range(0, len(spans), cap)]
            return [{"n": len(p), "start": p[0][0], "end": p[-1][1]} for p in parts]

        for batch in batches:
            rows = [None if row is None else [windows(t) for t in row] for row in batch.to_pylist()]
            yield pa.array(rows, pa.list_(pa.list_(_SPAN)))

    return cut(texts)


def tokenizer_count(text: Column, make_tokenizer: MakeTokenizer) -> Column:
    """Number of tokens a tokenizer finds."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenize = make_tokenizer()
        for batch in batches:
            yield pa.array([None if t is None else len(tokenize(t)) for t in batch.to_pylist()], pa.int64())

    return count(text)


def _windows(tokens: Column, cap: int) -> Column:
    """Cut a token array into consecutive slices of ``cap`` tokens."""
    n = F.size(tokens)
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), F.floor((n - 1) / cap).cast("int")),
            lambda i: F.slice(tokens, i * cap + 1, F.lit(cap)),
        ),
    ).otherwise(F.array().cast("array<array<string>>"))


def token_windows(df: DataFrame, text: str, cap: int = CHUNK_TOKENS, out: str = "chunks") -> DataFrame:
    """Fixed windows of ``cap`` tokens, as ``array<string>``."""
    return (
        df.withColumn("__w", words(F.col(text)))
        .withColumn(out, F.transform(_windows(F.col("__w"), cap), lambda w: F.array_join(w, " ")))
        .drop("__w")
    )


# The nested lambdas below read better, and reach the planner faster, as SQL.
# array(x) around a transform binds x, so that it is computed once.

# units over the cap become windows
_CUT_WORDS = r"""
flatten(transform(__counted, u -> IF(u.n <= {cap}, array(u),
  flatten(transform(array(filter(split(u.text, '\\s+'), w -> w <> '')), ws ->
    transform(sequence(0, CAST(floor((size(ws) - 1) / {cap}) AS INT)), i ->
      named_struct(
        'brk', u.brk AND i = 0,
        'n', CAST(least({cap}, size(ws) - i * {cap}) AS BIGINT),
        'text', array_join(slice(ws, i * {cap} + 1, {cap}), ' '))))))))
"""

# positions in __pieces where chunks start: a fold over the pages, in it one over a page
_STARTS = """
IF(size(__pieces) = 0, CAST(array() AS ARRAY<INT>),
  aggregate(
    element_at(transform(
      array(transform(__pieces, p -> named_struct('brk', p.brk, 'n', p.n))),
      sizes -> transform(
        sequence(0, CAST(floor((size(sizes) - 1) / {page}) AS INT)),
        i -> slice(sizes, i * {page} + 1, {page}))), 1),
    named_struct('held', 0L, 'pos', 0, 'starts', CAST(array() AS ARRAY<ARRAY<INT>>)),
    (acc, page) -> element_at(transform(
      array(aggregate(page,
        named_struct('held', acc.held, 'pos', acc.pos, 'starts', CAST(array() AS ARRAY<INT>)),
        (a, p) -> IF(a.pos = 0 OR p.brk OR a.held + p.n > {cap},
          named_struct('held', p.n, 'pos', a.pos + 1, 'starts', concat(a.starts, array(a.pos))),
          named_struct('held', a.held + p.n, 'pos', a.pos + 1, 'starts', a.starts)))),
      d -> named_struct('held', d.held, 'pos', d.pos, 'starts', concat(acc.starts, array(d.starts)))), 1),
    acc -> flatten(acc.starts)))
"""

_JOIN = r"""
transform(__starts, (s, i) -> array_join(transform(
  slice(__pieces, s + 1, coalesce(try_element_at(__starts, i + 2), size(__pieces)) - s),
  p -> p.text), '\n'))
"""


def greedy_chunks(
    df: DataFrame,
    units: str = "units",
    cap: int = CHUNK_TOKENS,
    out: str = "chunks",
    collapsed: bool = False,
    make_tokenizer: MakeTokenizer | None = None,
) -> DataFrame:
    """Pack consecutive units while their tokens stay within ``cap``.

    A unit over the cap is first cut into windows. A chunk never runs across a
    unit whose ``brk`` is set. Texts of a chunk are joined by a newline.

    Tokens are white-space separated words, or what the tokenizer says. Only unit
    texts go to a tokenizer's process, and only numbers come back.

    ``collapsed`` says that the white space in the units is collapsed already, as
    the built-in units have it, which makes counting cheaper.

    A fold over the token counts finds where chunks start. Spark copies the state of
    a fold at every step, so the fold runs page by page: a step copies the starts of
    one page, and the step from page to page one reference a page. They are put together once, at the end.
    """

    def spanned_pieces(u: Column, spans: Column) -> Column:
        return F.transform(
            spans,
            lambda w, i: F.struct(
                (u["brk"] & (i == 0)).alias("brk"),
                w["n"].alias("n"),
                F.when(F.size(spans) == 1, u["text"])
                .otherwise(F.substr(u["text"], w["start"] + 1, w["end"] - w["start"]))
                .alias("text"),
            ),
        )

    kept = F.filter(F.col(units), lambda u: not_blank(u["text"]))
    if make_tokenizer is None:
        counted = F.transform(
            kept,
            lambda u: F.struct(
                u["brk"].alias("brk"), token_count(u["text"], collapsed).alias("n"), u["text"].alias("text")
            ),
        )
        df = df.withColumn("__counted", counted)
        cut = F.expr(_CUT_WORDS.format(cap=cap))
    else:
        df = df.withColumn("__counted", kept)
        df = df.withColumn(
            "__spans", token_spans(F.transform("__counted", lambda u: u["text"]), make_tokenizer, cap)
        )
        cut = F.flatten(F.zip_with("__counted", "__spans", spanned_pieces))

    return (
        df.withColumn("__pieces", cut)
        .withColumn("__starts", F.expr(_STARTS.format(cap=cap, page=_PAGE)))
        .withColumn(out, F.expr(_JOIN))
        .drop("__counted", "__spans", "__pieces", "__starts")
    )


def numbered(chunks: Column, index_mode: str = "position") -> Column:
    """``array<struct<chunk_index, text>>`` of the non-blank chunks.

    ``position`` keeps the place in the full list, leaving gaps where blanks were;
    ``dense`` numbers what remains.
    """
    if index_mode not in ("position", "dense"):
        raise ValueError(f"index_mode must be 'position' or 'dense', not {index_mode!r}")
    if index_mode == "dense":
        return F.transform(
            F.filter(chunks, not_blank),
            lambda t, i: F.struct(i.cast("long").alias("chunk_index"), t.alias("text")),
        )
    return F.filter(
        F.transform(chunks, lambda t, i: F.struct(i.cast("long").alias("chunk_index"), t.alias("text"))),
        lambda c: not_blank(c["text"]),
    )


def explode_chunks(
    df: DataFrame, keys: list[str], chunks: str = "chunks", index_mode: str = "position"
) -> DataFrame:
    """One row per non-blank chunk: keys, chunk_index, text."""
    return df.select(*keys, F.explode(numbered(F.col(chunks), index_mode)).alias("c")).select(
        *keys, F.col("c.chunk_index").alias("chunk_index"), F.col("c.text").alias("text")
    )


def chunk_count(chunks: Column) -> Column:
    """Number of non-blank chunks of a document."""
    return F.size(F.filter(chunks, not_blank)).cast("long")
