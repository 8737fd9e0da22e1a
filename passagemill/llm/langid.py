"""Language identification by a byte convolutional network.

Bytes (ASCII lower-cased) are embedded; filters of several widths run over a window, each keeps its
greatest response, and a softmax over those gives the languages. The network is
trained in numpy on windows of a bounded sample of labelled texts. A text is cut into
windows of fixed length from start to end, all of which are scored in batches; their
log probabilities, weighted by letters, add up to the text's.

Null texts and texts without a letter are ``und`` with score 0. A table without
labelled texts gives ``und`` throughout. Repeated rows are scored alike; training takes them as
they come. Equal probabilities go to the language first in order. An
empty table stays empty. Extra columns pass through; a result column takes the place of one of its name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import kept, materialise, schema_of, text_slices

#: Bytes in a window.
WINDOW = 256
#: Labelled texts that the network is trained on, per language, and windows of each.
TRAIN_TEXTS = 400
TRAIN_WINDOWS = 3
#: Labelled texts in the whole sample; with many languages each brings fewer, one at least.
SAMPLE_TEXTS = 80_000
WIDTHS = (2, 3, 4)
EMBED, FILTERS, EPOCHS, RATE, SEED = 6, 12, 6, 4e-3, 5
UNKNOWN = "und"

_LOWER = bytes(c | 32 if 65 <= c <= 90 else c for c in range(256))
_LETTER = regex.compile(r"\p{L}")


def sample(docs: DataFrame, text: str, lang: str, doc_id: str, chosen: Column, per_language: int = TRAIN_TEXTS) -> list[tuple[str, list[bytes]]]:
    """(language, windows) of at most ``per_language`` texts of every language, by smallest hash; fewer if there would be over SAMPLE_TEXTS."""
    # by id and place, so that rows of one id, however many, aren't drawn together
    drawn = F.pmod(F.xxhash64(F.lit(SEED), F.col(doc_id), F.monotonically_increasing_id()), F.lit(1 << 30)) / float(1 << 30)
    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("t"), chosen.alias("chosen"), drawn.alias("u"))
    rows = known.where("chosen and lang is not null and t is not null")
    # the smallest hashes per language, without a language's rows in one task: a bound from its count, then the rank of few
    sizes = materialise(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    per_language = min(per_language, max(1, SAMPLE_TEXTS // max(1, sizes.count())))
    share = F.least(F.lit(1.0), F.lit(1.5 * per_language + 50) / F.col("n"))
    bound = F.broadcast(sizes.select(F.col("lang").alias("__lang"), share.alias("share")))
    few = rows.join(bound, F.col("lang") == F.col("__lang")).where(F.col("u") < F.col("share"))
    # a language's few are ranked where they lie, so that the driver takes no more than the sample
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("u"))).where(F.col("rank") <= per_language)
    # windows are cut here: a very long text brings no more than a short one
    size = F.octet_length(F.col("t"))
    body = F.col("t").cast("binary")
    starts = [F.least(F.greatest(F.floor((size - WINDOW) * k / max(1, TRAIN_WINDOWS - 1)), F.lit(0)), size).cast("int") for k in range(TRAIN_WINDOWS)]
    cut = F.array(*[F.substring(body, s + 1, F.lit(WINDOW)) for s in starts])
    found = few.select("lang", "u", cut.alias("cut")).sort("lang", "u").collect()
    out, many = [], {}
    for r in found:
        many[r.lang] = many.get(r.lang, 0) + 1
        if many[r.lang] <= per_language:
            out.append((r.lang, [bytes(x) for x in r.cut]))
    return out


def _matrix(pieces: list[bytes]) -> np.ndarray:
    raw = b"".join(p[:WINDOW].translate(_LOWER).ljust(WINDOW, b"\0") for p in pieces)
    return np.frombuffer(raw, np.uint8).reshape(-1, WINDOW)


def train(examples: list[tuple[str, list[bytes]]], epochs: int = EPOCHS, seed: int = SEED) -> tuple:
    """(languages, embedding, filters by width, output weights, bias) as arrays, by Adam on the log loss."""
    languages = sorted({lang for lang, _ in examples})
    if not languages:
        return [], None, [], None, None
    rng = np.random.default_rng(seed)
    pieces, labels = [], []
    for lang, windows in examples:
        for i, w in enumerate(windows):
            if len(w.strip()) == 0:
                continue
            if i:  # short texts must do as well
                w = w[: int(rng.integers(12, WINDOW + 1))]
            pieces.append(w)
            labels.append(languages.index(lang))
    if not pieces:
        return [], None, [], None, None
    x, y = _matrix(pieces), np.array(labels)
    k, wide = len(languages), len(WIDTHS) * FILTERS
    share = np.bincount(y, minlength=k)
    weight = (len(y) / (k * np.maximum(share, 1)))[y]
    p = [rng.normal(0, 0.5, (256, EMBED))]
    p += [rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)) for w in WIDTHS]
    p += [rng.normal(0, 0.1, (wide, k)), np.zeros(k)]
    p = [a.astype(np.float32) for a in p]
    p[0][0] = 0
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            rows = order[at : at + 64]
            grads = _gradient(p, x[rows], y[rows], weight[rows])
            step += 1
            for a, g, mm, vv in zip(p, grads, m, v):
                mm += 0.1 * (g - mm)
                vv += 0.01 * (g * g - vv)
                a -= RATE * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-8)
    return languages, p[0], p[1 : 1 + len(WIDTHS)], p[-2], p[-1]


def _stacked(e: np.ndarray, w: int) -> np.ndarray:
    """All runs of ``w`` embedded bytes, side by side."""
    n, t, d = e.shape
    s = e.strides
    return np.lib.stride_tricks.as_strided(e, (n, t - w + 1, w * d), (s[0], s[1], s[2]), writeable=False)


def _gradient(p, x, y, weight):
    table, filters, out, bias = p[0], p[1:-2], p[-2], p[-1]
    e = np.ascontiguousarray(table[x])
    pooled, best = [], []
    for w, f in zip(WIDTHS, filters):
        z = _stacked(e, w).reshape(-1, w * EMBED) @ f
        z = z.reshape(len(x), -1, FILTERS)
        b = z.argmax(1)
        best.append(b)
        pooled.append(np.take_along_axis(z, b[:, None], 1)[:, 0])
    raw = np.concatenate(pooled, 1)
    h = np.maximum(raw, 0)
    logit = h @ out + bias
    q = np.exp(logit - logit.max(1, keepdims=True))
    q /= q.sum(1, keepdims=True)
    q[np.arange(len(y)), y] -= 1
    q *= (weight / len(y))[:, None]
    q = q.astype(np.float32)
    g_out, g_bias = h.T @ q, q.sum(0)
    g_h = (q @ out.T) * (raw > 0)
    g_table, g_filters = np.zeros_like(table), []
    rows = np.arange(len(x))[:, None]
    for i, (w, f) in enumerate(zip(WIDTHS, filters)):
        g = g_h[:, i * FILTERS : (i + 1) * FILTERS]
        at = best[i]
        g_f = np.zeros_like(f)
        for o in range(w):
            symbol = x[rows, at + o]
            part = table[symbol]
            g_f[o * EMBED : (o + 1) * EMBED] = np.einsum("nfd,nf->df", part, g)
            np.add.at(g_table, symbol, g[:, :, None] * f[o * EMBED : (o + 1) * EMBED].T[None])
        g_filters.append(g_f)
    return [g_table, *g_filters, g_out, g_bias]


def window_scores(model: tuple, x: np.ndarray) -> np.ndarray:
    """Log probabilities of each window (rows of ``x``)."""
    _, table, filters, out, bias = model
    found = np.empty((len(x), len(bias)), np.float32)
    for at in range(0, len(x), 128):
        part = x[at : at + 128]
        e = np.ascontiguousarray(table[part])
        pooled = [(_stacked(e, w).reshape(-1, w * EMBED) @ f).reshape(len(part), -1, FILTERS).max(1) for w, f in zip(WIDTHS, filters)]
        logit = np.maximum(np.concatenate(pooled, 1), 0) @ out + bias
        logit -= logit.max(1, keepdims=True)
        found[at : at + 128] = logit - np.log(np.exp(logit).sum(1, keepdims=True))
    return found


def classify(model: tuple, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, probability) of each whole text."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    if not model[0]:
        return out
    rows = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
    if not rows:
        return out
    blobs = [texts[i].encode() for i in rows]
    # windows overlap by a filter's width less one, so that no run of bytes is lost
    stride = WINDOW - max(WIDTHS) + 1
    many = [max(1, -(-(len(b) - max(WIDTHS) + 1) // stride)) for b in blobs]
    x = _matrix([b[k * stride : k * stride + WINDOW] for b, n in zip(blobs, many) for k in range(n)])
    letters = (((x >= 97) & (x <= 122)) | (x >= 128)).sum(1).astype(np.float64)
    scores = window_scores(model, x).astype(np.float64) * (letters + 1e-3)[:, None]
    first = np.cumsum(many) - many
    total = np.add.reduceat(scores, first) / np.maximum(np.add.reduceat(letters + 1e-3, first), 1e-3)[:, None]
    best = total.argmax(1)
    odds = np.exp(total - total.max(1, keepdims=True))
    sure = 1 / odds.sum(1)
    for i, b, s in zip(rows, best.tolist(), sure.tolist()):
        out[i] = (model[0][b], min(1.0, max(0.0, s)))
    return out


def identify(docs: DataFrame, model: tuple, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred and score."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    source = docs.select(*keep) if text in keep else docs.select(*keep, text)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shipped.value
        for batch in batches:
            for part in text_slices(batch, text, 1 << 20):
                found = classify(known, part.column(text).to_pylist())
                arrays = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*kept(part, keep), *arrays], [*keep, "lang_pred", "score"])

    return source.mapInArrow(run, schema_of(docs, keep, ("lang_pred", "string"), ("score", "double")))
