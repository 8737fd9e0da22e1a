"""Answers for a table of prompts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import STORED_ERROR_CHARS, GenerationConfig
from .embedding import http_json_client

# ---- fixed values ----------------------------------------------------------------
NOT_IN_CONTEXT = "The answer is not in the context."
CHAT_ROUTE = "/chat/completions"
# ----------------------------------------------------------------------------------


class ChatEndpoint:
    """Generator that calls a chat service, one user message per prompt.

    ``make_client`` returns a callable ``payload dict -> reply dict``.
    """

    def __init__(self, make_client: Callable[[], Callable[[dict], dict]], model: str,
                 config: GenerationConfig = GenerationConfig()):
        self.make_client, self.model, self.config = make_client, model, config

    @staticmethod
    def at(url: str, model: str, config: GenerationConfig = GenerationConfig()) -> ChatEndpoint:
        target = url.rstrip("/") + CHAT_ROUTE
        return ChatEndpoint(lambda: http_json_client(target, config.timeout_s), model, config)

    def load(self) -> Callable[[str], str]:
        post = self.make_client()

        def ask(prompt: str) -> str:
            reply = post(
                {
                    "model": self.model,
                    "messages": [{"role": "user", "content": prompt}],
                    "max_tokens": self.config.max_tokens,
                    "temperature": self.config.temperature,
                }
            )
            return reply["choices"][0]["message"]["content"]

        return ask


#: Requests that a task has under way at a time.
AT_ONCE = 8
_REPLY = pa.struct([("answer", pa.string()), ("error", pa.string())])


def _ask_all(ask, prompts: list, pool) -> list[dict]:
    """(answer, error) of each prompt, in order; one failure doesn't stop the others."""

    def one(prompt):
        if prompt is None:
            return {"answer": None, "error": None}
        try:
            return {"answer": ask(prompt), "error": None}
        except Exception as problem:
            return {"answer": None, "error": f"{type(problem).__name__}: {problem}"[:STORED_ERROR_CHARS]}

    return list(pool.map(one, prompts))


def replies(prompt: Column, generator, at_once: int = AT_ONCE) -> Column:
    """``struct<answer, error>``; ``generator.load()`` runs once per task, which keeps
    up to ``at_once`` requests under way."""

    @F.arrow_udf("struct<answer: string, error: string>")
    def answer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ask = generator.load()
        with ThreadPoolExecutor(at_once) as pool:
            for prompts in batches:
                yield pa.array(_ask_all(ask, prompts.to_pylist(), pool), _REPLY)

    return answer(prompt)


def generated(prompt: Column, generator, at_once: int = AT_ONCE) -> Column:
    """Answer column; null where the request failed (see :func:`replies` for the reason)."""
    return replies(prompt, generator, at_once)["answer"]


def generated_by_model(prompts: DataFrame, generators: dict, model: str = "model", prompt: str = "prompt",
                       out: str = "answer") -> DataFrame:
    """Each row is answered by the generator its ``model`` column names, in one pass.

    Rows whose model is unknown get no answer.
    """

    @F.arrow_udf("string")
    def answer(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        loaded: dict = {}
        with ThreadPoolExecutor(AT_ONCE) as pool:
            for names, texts in batches:
                answers: list = [None] * len(names)
                places: dict = {}
                for i, name in enumerate(names.to_pylist()):
                    if name in generators:
                        places.setdefault(name, []).append(i)
                for name, at in places.items():
                    if name not in loaded:
                        loaded[name] = generators[name].load()
                    found = _ask_all(loaded[name], texts.take(pa.array(at)).to_pylist(), pool)
                    for i, reply in zip(at, found):
                        answers[i] = reply["answer"]
                yield pa.array(answers, pa.string())

    return prompts.withColumn(out, answer(F.col(model), F.col(prompt)))


def first_line(text: Column) -> Column:
    return F.element_at(F.split(text, "\n"), 1)


def extractive_answer(hits: Column) -> Column:
    """Built-in offline answer: the first line of the best hit."""
    best = F.try_element_at(hits, F.lit(1))["text"]
    return F.coalesce(first_line(best), F.lit(NOT_IN_CONTEXT))


def compare_answers(with_context: DataFrame, generator, question: str = "question") -> DataFrame:
    """Add ``direct_answer``, given without context, beside ``answer``."""
    return with_context.withColumn("direct_answer", generated(F.col(question), generator))
