"""Embedding: a text column becomes a vector column on the same row.

An embedder is any object with ``load()`` returning a callable
``list[str] -> array of shape (n, dim)``; ``load`` runs once per task, so models
are built where they are used. Only the text column crosses to Python.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EMBEDDING_DIM, STORED_ERROR_CHARS
from ..functions.text import words

# ---- fixed values ------------------------------------------------------------
SUB_BATCH = 64
ENDPOINT_TIMEOUT_S = 120
EMBEDDINGS_ROUTE = "/v1/embeddings"
# ------------------------------------------------------------------------------

_VECTOR = "array<float>"
#: Components of vectors, and tokens, that a task works on at a time, and tokens whose place it remembers.
_CELLS_AT_ONCE = 1_000_000
_TOKENS_AT_ONCE = 250_000
_KNOWN_TOKENS = 400_000


def _to_lists(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix, dtype=np.float32)
    n, dim = matrix.shape
    offsets = np.arange(0, (n + 1) * dim, dim, dtype=np.int32) if dim else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(matrix.ravel()))


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=matrix.copy(), where=norms > 0)


# ---- built-in: feature hashing -------------------------------------------------


def _slices(lengths: np.ndarray, rows: int, tokens: int) -> Iterator[tuple[int, int]]:
    """Runs (start, end) of at most ``rows`` lists with at most ``tokens`` in all; a longer list is a run of its own."""
    ends, at = np.cumsum(lengths, dtype=np.int64), 0
    while at < len(lengths):
        before = ends[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + tokens, side="right"))))
        yield at, end
        at = end


def _bucket(token: str, dim: int) -> tuple[int, int]:
    h = int.from_bytes(hashlib.md5(token.encode("utf-8")).digest()[:4], "big")
    return h % dim, 1 if (h // dim) % 2 == 0 else -1


def hashed_vectors(text: Column, dim: int = EMBEDDING_DIM, normalize: bool = False) -> Column:
    """Feature hashing of the lower-cased tokens: no model, same result everywhere.

    Each token adds +1 or -1 to one component, both taken from its MD5. Without
    ``normalize`` the components are whole numbers, so that dot products, and with
    them cosines, carry no rounding error; ranking by cosine is the same.
    """

    @F.arrow_udf(_VECTOR)
    def hash_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, int] = {}  # twice the component, odd if it falls by one
        step = max(1, _CELLS_AT_ONCE // dim)
        for batch in batches:
            parts = []
            for at, end in _slices(np.diff(np.asarray(batch.offsets)), step, _TOKENS_AT_ONCE):
                tokens = batch.slice(at, end - at)
                n = len(tokens)
                lengths = np.diff(np.asarray(tokens.offsets))
                coded = tokens.flatten().dictionary_encode()
                if len(known) > _KNOWN_TOKENS:
                    known.clear()
                table = np.zeros(len(coded.dictionary), dtype=np.int64)
                for i, token in enumerate(coded.dictionary.to_pylist()):
                    place = known.get(token)
                    if place is None:
                        component, sign = _bucket(token, dim)
                        place = known[token] = 2 * component + (sign < 0)
                    table[i] = place
                place = table[np.asarray(coded.indices)]
                row = np.repeat(np.arange(n), lengths)
                flat = np.bincount(row * dim + (place >> 1), weights=1 - 2 * (place & 1), minlength=n * dim)
                matrix = flat.astype(np.float64, copy=False).reshape(n, dim)  # bincount of nothing counts in int
                parts.append(_to_lists(_unit_rows(matrix) if normalize else matrix))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))

    # a missing text has no vector
    return F.when(text.isNotNull(), hash_tokens(words(F.lower(F.coalesce(text, F.lit(""))))))


# ---- user models ----------------------------------------------------------------


class LocalEmbedder:
    """Wraps a factory of an encode function; rows are brought to unit length."""

    def __init__(self, make_encoder: Callable[[], Callable[[list[str]], object]], normalize: bool = True):
        self.make_encoder = make_encoder
        self.normalize = normalize

    def load(self) -> Callable[[list[str]], np.ndarray]:
        encode = self.make_encoder()
        return lambda texts: (
            _unit_rows(np.asarray(encode(texts), dtype=np.float64))
            if self.normalize
            else np.asarray(encode(texts), dtype=np.float64)
        )


class EndpointEmbedder:
    """Calls an embeddings service in sub-batches; vectors are used as returned.

    ``make_client`` returns a callable ``payload dict -> reply dict``. The reply's
    entries are put back into request order by their ``index``.
    """

    def __init__(self, make_client: Callable[[], Callable[[dict], dict]], model: str, sub_batch: int = SUB_BATCH):
        self.make_client = make_client
        self.model = model
        self.sub_batch = sub_batch

    def load(self) -> Callable[[list[str]], np.ndarray]:
        post, model, size = self.make_client(), self.model, self.sub_batch

        def encode(texts: list[str]) -> np.ndarray:
            placed: list = [None] * len(texts)
            for at in range(0, len(texts), size):
                asked = texts[at : at + size]
                for entry in post({"model": model, "input": asked})["data"]:
                    place = entry["index"]
                    if not 0 <= place < len(asked) or placed[at + place] is not None:
                        raise ValueError(f"asked for {len(asked)} vectors, got index {place} beyond them or twice")
                    placed[at + place] = entry["embedding"]
            lost = sum(v is None for v in placed)
            if lost:
                raise ValueError(f"asked for {len(texts)} vectors, {lost} did not come")
            return np.asarray(placed, dtype=np.float64)

        return encode


#: HTTP answers after which the same request may succeed.
TRANSIENT = (408, 425, 429, 500, 502, 503, 504)


def is_transient(problem: Exception) -> bool:
    """Whether to ask again: a busy or restarting service, a lost connection, a time limit."""
    return getattr(problem, "code", None) in TRANSIENT or isinstance(problem, (ConnectionError, TimeoutError))


class PipelinedEndpoint(EndpointEmbedder):
    """An embeddings service asked for several sub-batches at a time.

    At most ``window`` requests are under way in a task; their vectors come out in the order of the texts.
    A transient failure is tried again after a pause that doubles; what fails for good gives a null
    vector and its error, and the job goes on. See :func:`embed_or_error`.
    """

    def __init__(self, make_client, model: str, sub_batch: int = SUB_BATCH, window: int = 8, attempts: int = 5, pause_s: float = 0.5, most_pause_s: float = 30.0):
        super().__init__(make_client, model, sub_batch)
        self.window, self.attempts, self.pause_s, self.most_pause_s = window, attempts, pause_s, most_pause_s

    def load_one(self) -> Callable[[list[str]], tuple[object, str | None, int]]:
        """A function from a sub-batch's texts to (vectors or None, error or None, attempts)."""
        encode = self.load()
        attempts, pause_s, most = self.attempts, self.pause_s, self.most_pause_s

        def one(texts: list[str]) -> tuple[object, str | None, int]:
            for n in range(1, attempts + 1):
                try:
                    return encode(texts), None, n
                except Exception as problem:  # one bad request must not stop the others
                    if n == attempts or not is_transient(problem):
                        return None, f"{type(problem).__name__}: {problem}"[:STORED_ERROR_CHARS], n
                    time.sleep(min(most, pause_s * 2 ** (n - 1)))
            raise AssertionError("unreachable")

        return one


def embed_or_error(df: DataFrame, embedder: PipelinedEndpoint, text: str = "text", out: str = "embedding") -> DataFrame:
    """Add ``out``, ``error`` and ``attempts``: a vector, or why there is none. A missing text has neither and no attempt."""

    @F.arrow_udf("struct<embedding:array<float>,error:string,attempts:int>")
    def ask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = embedder.load_one()
        kind = pa.struct([("embedding", pa.list_(pa.float32())), ("error", pa.string()), ("attempts", pa.int32())])
        with ThreadPoolExecutor(embedder.window) as pool:
            # requests of the next batches start before this one's answers are all there: windows don't end with batches
            waiting: deque = deque()

            def finished(job) -> pa.Array:
                valid, futures = job
                rows = []
                for size, future in futures:
                    vectors, error, n = future.result()
                    rows += [(None if vectors is None else vectors[i], error, n) for i in range(size)]
                found = iter(rows)
                return pa.array([dict(zip(("embedding", "error", "attempts"), next(found))) if ok else {"attempts": 0} for ok in valid], kind)

            for texts in batches:
                known = texts.drop_null().to_pylist()
                parts = [known[i : i + embedder.sub_batch] for i in range(0, len(known), embedder.sub_batch)]
                waiting.append((np.asarray(texts.is_valid()).tolist(), [(len(p), pool.submit(one, p)) for p in parts]))
                while len(waiting) > 1:
                    yield finished(waiting.popleft())
            while waiting:
                yield finished(waiting.popleft())

    asked = df.withColumn("__asked", ask(F.col(text)))
    return asked.withColumns({out: F.col("__asked.embedding"), "error": F.col("__asked.error"), "attempts": F.col("__asked.attempts")}).drop("__asked")


def http_json_client(url: str, timeout_s: float = ENDPOINT_TIMEOUT_S) -> Callable[[dict], dict]:
    """A POST function for a JSON service; any HTTP error status raises."""
    from urllib.request import Request, urlopen

    def post(payload: dict) -> dict:
        request = Request(url, json.dumps(payload).encode("utf-8"), {"Content-Type": "application/json"})
        with urlopen(request, timeout=timeout_s) as reply:
            return json.loads(reply.read())

    return post


def choose_embedder(endpoint: str, model: str, make_encoder: Callable | None = None):
    """Endpoint if a URL is given, else the local model."""
    if endpoint:
        url = endpoint.rstrip("/") + EMBEDDINGS_ROUTE
        return EndpointEmbedder(lambda: http_json_client(url), model)
    if make_encoder is None:
        raise ValueError("without an endpoint a local encoder is needed")
    return LocalEmbedder(make_encoder)


def model_vectors(text: Column, embedder, sub_batch: int = 1024) -> Column:
    """Vectors of a user-supplied embedder."""

    @F.arrow_udf(_VECTOR)
    def encode_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = embedder.load()
        for texts in batches:
            parts = []
            for at in range(0, len(texts), sub_batch):
                asked = texts.slice(at, sub_batch)
                known = asked.drop_null().to_pylist()
                if not known:
                    parts.append(pa.nulls(len(asked), pa.list_(pa.float32())))
                    continue
                found = _to_lists(np.asarray(encode(known), dtype=np.float64).reshape(len(known), -1))
                if len(known) < len(asked):  # a missing text has no vector
                    valid = np.asarray(asked.is_valid())
                    found = found.take(pa.array(np.cumsum(valid) - 1, mask=~valid))
                parts.append(found)
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))

    return encode_texts(text)


def embed(df: DataFrame, embedder=None, text: str = "text", out: str = "embedding", dim: int = EMBEDDING_DIM,
          normalize: bool = True) -> DataFrame:
    """Add a vector column; feature hashing unless an embedder is given."""
    if embedder is None:
        return df.withColumn(out, hashed_vectors(F.col(text), dim, normalize))
    return df.withColumn(out, model_vectors(F.col(text), embedder))


# ---- replies kept as a table ----------------------------------------------------

REPLY = "struct<data:array<struct<embedding:array<double>,index:int>>>"


def vectors_of_reply(reply_json: Column) -> Column:
    """Vectors of a stored service reply, in request order."""
    data = F.from_json(reply_json, REPLY)["data"]
    ordered = F.array_sort(
        F.transform(data, lambda d: F.struct(d["index"].alias("index"), d["embedding"].alias("embedding")))
    )
    return F.transform(ordered, lambda d: d["embedding"])
