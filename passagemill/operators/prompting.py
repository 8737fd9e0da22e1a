"""Context blocks and prompts for a table of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed3

# ---- fixed values: wording and layout of the prompt -----------------------------
CONTEXT_SEPARATOR = "\n\n---\n\n"
SYSTEM_SENTENCES = (
    "You are a helpful assistant. Answer the user's question based on the provided context documents. "
    "If the answer is not in the context, say so."
)
CONTEXT_HEADER = "## Context"
QUESTION_HEADER = "## Question"
ANSWER_HEADER = "## Answer"
# ----------------------------------------------------------------------------------


def context_line(source: Column, chunk_index: Column, score: Column, text: Column, label: str = "score") -> Column:
    return F.concat(
        F.lit("[Source: "), source.cast("string"),
        F.lit(", chunk "), chunk_index.cast("string"),
        F.lit(f", {label}: "), fixed3(score),
        F.lit("]\n"), text,
    )


def context_block(hits: Column, label: str = "score") -> Column:
    """Contexts of an array of hits, in its order; an empty string without hits."""
    lines = F.transform(
        hits,
        lambda h: context_line(h["source_file"], h["chunk_index"], h["score"], h["text"], label),
    )
    return F.coalesce(F.array_join(lines, CONTEXT_SEPARATOR), F.lit(""))


def prompt_text(context: Column, question: Column) -> Column:
    gap = "\n\n"
    return F.concat(
        F.lit(f"{SYSTEM_SENTENCES}{gap}{CONTEXT_HEADER}{gap}"), F.coalesce(context, F.lit("")),
        F.lit(f"{gap}{QUESTION_HEADER}{gap}"), question,
        F.lit(f"{gap}{ANSWER_HEADER}{gap}"),
    )


def build_prompts(gathered: DataFrame, question: str = "question", hits: str = "hits", label: str = "score") -> DataFrame:
    """Add ``context`` and ``prompt``; a question without hits keeps an empty context."""
    return gathered.withColumn("context", context_block(F.col(hits), label)).withColumn(
        "prompt", prompt_text(F.col("context"), F.col(question))
    )
