"""Language-model scores from a lattice of subwords.

A word is scored by all its segmentations into pieces of an existing vocabulary: the
pieces' scores weight the paths, and a forward recursion in logarithms adds them up to
the marginal probability of the word. Words are independent, so that the marginal of a
document is the product of its words' and of the end's. The vocabulary's own scores
(ranks of a public tokenizer) give the first weights; expected counts of the pieces,
taken by forward and backward recursion over all training words, give the final ones.
Characters that the vocabulary lacks are spelled in its byte pieces, so every text has
a probability.

Words are counted once over all documents and scored once each. The most frequent ones, of bounded
bytes, are shipped to the tasks; all others are joined to the documents by word.

Null texts are empty: one token, the end. Without training documents the vocabulary's
first weights are used and every count is 0. Ties and repeated rows are rows of their own. An empty table stays
empty. Extra columns pass through; a result column takes the place of one of its name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, materialise, text_slices, texts_of

#: Bytes of frequent words (and 24 a word) that are shipped to every task.
SHIPPED_BYTES = 10 << 20
#: Different words that a task counts before it hands on what it has.
TASK_WORDS = 400_000
ROUNDS = 1
MARK = "▁"
_LN10 = math.log(10.0)


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, first weight) of a sentencepiece model; byte pieces are ``<0x..>``; the last is the end.

    Merge vocabularies score a piece by its rank; its weight then falls as one over the rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        rank = model.get_piece_size() if model.is_byte(i) else -model.get_score(i)
        out.append((model.id_to_piece(i), 1.0 / (rank + 20.0)))
    out.append(("</s>", 0.01))
    total = sum(w for _, w in out)
    return [(p, w / total) for p, w in out]


def tree(pieces: list[str], logs: list[float]) -> tuple[dict, list[int]]:
    """Pieces by letters: {letter: [piece number or -1, log weight, tree]}; and the numbers of the 256 byte pieces."""
    root: dict = {}
    raw = [-1] * 256
    for i, p in enumerate(pieces[:-1]):
        if len(p) == 6 and p.startswith("<0x"):
            raw[int(p[3:5], 16)] = i
            continue
        at, node = root, None
        for c in p:
            node = at.setdefault(c, [-1, 0.0, {}])
            at = node[2]
        node[0], node[1] = i, logs[i]
    return root, raw


def _edges(s: str, start: int, root: dict, raw: list[int], logs: list[float]) -> list[tuple[int, float, int]]:
    """(end, log weight, piece) of the pieces that begin at ``start``; piece -1 for spelled bytes."""
    found, at, j, n = [], root, start, len(s)
    while j < n:
        node = at.get(s[j])
        if node is None:
            break
        j += 1
        if node[0] >= 0:
            found.append((j, node[1], node[0]))
        at = node[2]
    if not found or found[0][0] != start + 1:  # the character is no piece of its own
        found.append((start + 1, sum(logs[raw[b]] for b in s[start].encode()), -1))
    return found


def forward(s: str, root: dict, raw: list[int], logs: list[float]) -> float:
    """Natural logarithm of the marginal probability of ``s``."""
    exp, log = math.exp, math.log
    n = len(s)
    arrived: dict[int, list[float]] = {0: [0.0]}
    alpha = 0.0
    for i in range(n):
        into = arrived.pop(i)
        if len(into) == 1:
            alpha = into[0]
        else:
            top = max(into)
            alpha = top + log(sum([exp(x - top) for x in into]))
        for j, w, _ in _edges(s, i, root, raw, logs):
            if j in arrived:
                arrived[j].append(alpha + w)
            else:
                arrived[j] = [alpha + w]
    into = arrived[n]
    top = max(into)
    return top + log(sum([exp(x - top) for x in into]))


def expect(s: str, times: float, root: dict, raw: list[int], logs: list[float], into: np.ndarray) -> None:
    """Add the expected counts of the pieces in ``times`` copies of ``s``."""
    exp, log = math.exp, math.log
    n = len(s)
    edges = [_edges(s, i, root, raw, logs) for i in range(n)]
    alpha = [-math.inf] * (n + 1)
    alpha[0] = 0.0
    for i in range(n):
        a = alpha[i]
        for j, w, _ in edges[i]:
            x, y = a + w, alpha[j]
            if x < y:
                x, y = y, x
            alpha[j] = x if y == -math.inf else x + log(1.0 + exp(y - x))
    beta = [-math.inf] * (n + 1)
    beta[n] = 0.0
    whole = alpha[n]
    for i in range(n - 1, -1, -1):
        terms = [w + beta[j] for j, w, _ in edges[i]]
        top = max(terms)
        beta[i] = top + log(sum([exp(x - top) for x in terms]))
        for (_, _, piece), x in zip(edges[i], terms):
            share = times * exp(alpha[i] + x - whole)
            if piece >= 0:
                into[piece] += share
            else:
                for b in s[i].encode():
                    into[raw[b]] += share


def count_words(docs: DataFrame, text: str, train: str) -> DataFrame:
    """(word, n, c): occurrences of each word in all documents and in those marked ``train``."""

    def rows(n: Counter, c: Counter) -> pa.RecordBatch:
        words = list(n)
        arrays = [pa.array(words, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([c[w] for w in words], pa.int64())], ["word", "n", "c"])

    def run(batches):
        n, c = Counter(), Counter()
        for batch in batches:
            for part in text_slices(batch, "t"):
                for t, own in zip(texts_of(part.column("t")), part.column("train").to_pylist()):
                    words = t.lower().split()
                    n.update(words)
                    if own:
                        c.update(words)
                if len(n) > TASK_WORDS:
                    yield rows(n, c)
                    n, c = Counter(), Counter()
        yield rows(n, c)

    found = docs.select(F.col(text).alias("t"), F.col(train).alias("train")).mapInArrow(run, "word string, n bigint, c bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def learn(words: DataFrame, ends: int, pieces: list[tuple[str, float]], rounds: int = ROUNDS) -> list[float]:
    """Log weights of the pieces, from their expected counts over all training words and ends."""
    names, weights = [p for p, _ in pieces], np.array([w for _, w in pieces])
    for _ in range(rounds):
        shipped = words.sparkSession.sparkContext.broadcast((names, np.log(weights).tolist()))

        def run(batches, shipped=shipped):
            names, logs = shipped.value
            root, raw = tree(names, logs)
            total = np.zeros(len(names))
            for batch in batches:
                for w, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist()):
                    expect(MARK + w, c, root, raw, logs, total)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["piece", "n"])

        found = words.where("c > 0").select("word", "c").mapInArrow(run, "piece bigint, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = np.zeros(len(names))
        for r in found.collect():  # one row a piece of the vocabulary
            counts[r.piece] = r.n
        counts[-1] = ends
        if counts.sum() == 0:
            break
        counts += 0.5 * weights * len(weights)
        weights = counts / counts.sum()
    return np.log(weights).tolist()


def scored_words(words: DataFrame, names: list[str], logs: list[float]) -> DataFrame:
    """``words`` with logp, the log10 of each word's marginal probability."""
    shipped = words.sparkSession.sparkContext.broadcast((names, logs))

    def run(batches):
        names, logs = shipped.value
        root, raw = tree(names, logs)
        for batch in batches:
            found = [forward(MARK + w, root, raw, logs) / _LN10 for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "logp"])

    return words.mapInArrow(run, "word string, n bigint, c bigint, logp double")


def frequent(words: DataFrame, most_bytes: int = SHIPPED_BYTES) -> dict[bytes, tuple[int, float]]:
    """(count in training, logp) of the most frequent words, as many as fit in ``most_bytes``."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    size = F.octet_length("word") + 24
    least, total = None, 0
    for r in words.groupBy(step.alias("step")).agg(F.sum(size).alias("size")).orderBy(F.desc("step")).collect():  # at most 8 * 63 rows
        if (total := total + r["size"]) > most_bytes:
            break
        least = r.step
    if least is None:
        return {}
    found = words.where(step >= least).select("word", "c", "logp").toArrow()
    return dict(zip(texts_of(found.column("word").combine_chunks()), zip(found.column("c").to_pylist(), found.column("logp").to_pylist())))


def lattice_scores(
    docs: DataFrame,
    model_path: str,
    train: Column,
    text: str = "text",
    keep: Sequence[str] | None = None,
    rounds: int = ROUNDS,
    most_bytes: int = SHIPPED_BYTES,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_tokens, n_known, train_tokens, base_score and score (log10)."""
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results]
    marked = docs.select(F.col(text).alias("__t"), train.alias("__train"))
    words = materialise(count_words(marked, "__t", "__train"), "words")
    total, kinds = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = docs.where(train).count()
    total, kinds = total + ends, kinds + (ends > 0)
    pieces = vocabulary(model_path)
    logs = learn(words, ends, pieces, rounds)
    names = [p for p, _ in pieces]
    scored = materialise(scored_words(words, names, logs), "scored-words")
    shipped = docs.sparkSession.sparkContext.broadcast((frequent(scored, most_bytes), ends, logs[-1] / _LN10))

    # the kept columns travel with the row number of the one scan that gives it, so no other scan has to agree with it
    spared = [f"__own_{i}" for i in range(len(keep))]
    kinds_of = [docs.schema[c].dataType for c in keep]
    fields = [("__rid", "long"), ("__word", "string"), ("__n", "long"), ("__known", "long"), ("__base", "double"), ("__logp", "double")]
    columns = [*spared, *[f for f, _ in fields]]

    def run(batches):
        known, ends, end_logp = shipped.value
        log10 = {}
        for batch in batches:
            for part in text_slices(batch, "__t"):
                rid, word, times = [], [], []
                sums = []
                for row, t in zip(part.column("__rid").to_pylist(), texts_of(part.column("__t"))):
                    found = Counter(t.lower().split())
                    n, sure, base, logp = 1, int(ends > 0), math.log10(ends + 0.5), end_logp
                    for w, m in found.items():
                        n += m
                        hit = known.get(w)
                        if hit is None:
                            rid.append(row)
                            word.append(w)
                            times.append(m)
                            continue
                        c, lp = hit
                        if c not in log10:
                            log10[c] = math.log10(c + 0.5)
                        if c:
                            sure += m
                        base += m * log10[c]
                        logp += m * lp
                    sums.append((row, n, sure, base, logp))
                own = [pa.array(x) for x in zip(*sums)]
                own = [own[0], pa.nulls(len(sums), pa.string()), *[a.cast(t) for a, t in zip(own[1:], (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]]
                yield pa.RecordBatch.from_arrays([*kept(part, spared), *own], columns)
                if rid:
                    none = [pa.nulls(len(rid), part.column(c).type) for c in spared]
                    rest = [pa.array(rid, pa.int64()), pa.array(word, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())]
                    blank = pa.nulls(len(rid), pa.float64())
                    yield pa.RecordBatch.from_arrays([*none, *rest, pa.nulls(len(rid), pa.int64()), blank, blank], columns)

    own_columns = [F.col(c).alias(n) for c, n in zip(keep, spared)]
    source = docs.select(*own_columns, F.monotonically_increasing_id().alias("__rid"), F.col(text).alias("__t"))
    schema = T.StructType([T.StructField(n, k) for n, k in zip(spared, kinds_of)])
    for name, kind in fields:
        schema = schema.add(name, kind)
    parts = materialise(source.mapInArrow(run, schema), "parts")
    rare = parts.where("__word is not null").select("__rid", "__word", F.col("__n").alias("__m"))
    rare = rare.join(scored.select(F.col("word").alias("__word"), "c", "logp"), "__word")
    rare = rare.groupBy("__rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("__m")).otherwise(0)).alias("known"),
        F.sum(F.col("__m") * F.log10(F.col("c") + 0.5)).alias("base"),
        F.sum(F.col("__m") * F.col("logp")).alias("logp"),
    )
    rare = rare.select(F.col("__rid").alias("__rare"), *[F.col(c).alias(f"__more_{c}") for c in ("known", "base", "logp")])
    rows = parts.where("__word is null").join(rare, F.col("__rid") == F.col("__rare"), "left")
    both = {c: F.col(f"__{c}") + F.coalesce(f"__more_{c}", F.lit(0)) for c in ("known", "base", "logp")}
    floor = math.log10(total + 0.5 * (kinds + 1))
    return rows.select(
        *[F.col(n).alias(c) for c, n in zip(keep, spared)],
        F.col("__n").alias("n_tokens"),
        both["known"].alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (both["base"] - F.col("__n") * floor).alias("base_score"),
        both["logp"].alias("score"),
    )
