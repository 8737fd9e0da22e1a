"""Quality rules with thresholds that adapt to language and source.

Per document: rates of the usual heuristics (word length, symbols, repeated lines,
repeated windows). Per language and source, a mergeable quantile sketch of each rate: counts in bins
whose bounds grow by a fixed ratio, so that a quantile is known to one bin and two
sketches merge by adding counts. A rate's thresholds lie a multiple of the
spread (median to upper or lower decile) beyond the deciles of its group; a document beyond any of
them is rejected. Most documents have no symbols and repeats at all, so that the spread can be 0: it is at
least one more of them in a document of the group's median length, which the group's sketch of lengths
gives. No threshold is a constant. Groups with too few documents are merged into their language's
sketch, and those into the sketch of all.

Null texts are empty: they have no words and fail the base rules. Null language and null
source are groups of their own. Ties are equal values and share their verdict.
Repeated rows count as often as they occur. An empty table stays empty. Extra columns pass
through; a result column takes the place of one of its name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import join_groups, kept, materialise, schema_of, text_slices, texts_of

WINDOW_WORDS = 8
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A sketch of fewer documents is merged into the next wider one.
MIN_GROUP = 100
#: Bins of the sketch grow by this ratio.
RATIO = 1.01
#: How many spreads beyond the decile a threshold lies.
REACH = 3.0

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rates, in parts of a million words: what is counted, and how many words one more of them adds (two windows, for repeats).
RATES = {
    "word_length": ("word_chars", 0),
    "symbols": ("n_symbols", 1),
    "dup_lines": ("n_dup_lines", 1),
    "repeats": ("n_repeat_words", 2 * WINDOW_WORDS),
}
_TWO_SIDED = ("word_length",)
#: Sketched beside the rates.
_LENGTH = "n_words"


def features(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the counts named in FEATURES."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in FEATURES]
    source = docs.select(*keep) if text in keep else docs.select(*keep, text)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text, 1 << 20):
                rows = np.array(counts(texts_of(part.column(text))), np.int64).reshape(5, -1)
                yield pa.RecordBatch.from_arrays([*kept(part, keep), *[pa.array(r) for r in rows]], [*keep, *FEATURES])

    return source.mapInArrow(run, schema_of(docs, keep, *[(f, "bigint") for f in FEATURES]))


_WHITE = b" \t\n\x0b\f\r"
_TAIL = bytes(range(0x80, 0xC0))


def counts(texts: list[bytes]) -> list[list[int]]:
    """FEATURES of each text."""
    words = [t.split() for t in texts]
    chars = [len(t.translate(None, _WHITE + _TAIL)) for t in texts]
    symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]
    return [list(map(len, words)), chars, symbols, list(map(_dup_lines, texts)), _repeats(words)]


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _repeats(docs: list[list[bytes]], n: int = WINDOW_WORDS) -> list[int]:
    """Words in windows of ``n`` words that a text has twice or more.

    Rolling hashes of all texts together find windows that may repeat; only those are compared.
    """
    out = [0] * len(docs)
    sizes = np.array([len(w) for w in docs])
    total = int(sizes.sum())
    if total < n:
        return out
    h = np.fromiter((hash(w) for d in docs for w in d), np.int64, total).view(np.uint64)
    doc = np.repeat(np.arange(len(docs)), sizes)
    roll = np.zeros(total - n + 1, np.uint64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    for k in range(n):
        roll = roll * mix + h[k : total - n + 1 + k]
    at = np.flatnonzero(doc[: total - n + 1] == doc[n - 1 :])
    key = (roll[at] ^ (roll[at] >> np.uint64(29))) + doc[at].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    ranked = np.sort(key)
    again = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(again):
        return out
    slot = np.minimum(np.searchsorted(again, key), len(again) - 1)
    at = at[again[slot] == key]
    first = np.cumsum(sizes) - sizes
    for i in np.unique(doc[at]).tolist():
        w, base = docs[i], int(first[i])
        places = (at[doc[at] == i] - base).tolist()
        windows = [tuple(w[p : p + n]) for p in places]
        often = Counter(windows)
        change = np.zeros(len(w) + 1, np.int64)
        for p, x in zip(places, windows):
            if often[x] > 1:
                change[p] += 1
                change[p + n] -= 1
        out[i] = int((np.cumsum(change) > 0).sum())
    return out


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rate(name: str) -> Column:
    """A rate in parts of a million, as a whole number."""
    return F.coalesce(F.try_divide(F.col(RATES[name][0]) * 1_000_000, F.col("n_words")).cast("long"), F.lit(0))


def _rate_column(name: str) -> str:
    return f"__rate_{name}"


def with_rates(rows: DataFrame) -> DataFrame:
    return rows.withColumns({_rate_column(r): rate(r) for r in RATES})


def _bin(value: Column) -> Column:
    """Bin of a whole number: -1 for zero, else the power of RATIO below it."""
    return F.when(value <= 0, -1).otherwise(F.floor(F.log(value.cast("double")) / float(np.log(RATIO)))).cast("int")


def _value(bin_: Column, above: bool) -> Column:
    return F.when(bin_ < 0, 0.0).otherwise(F.pow(F.lit(RATIO), bin_ + (1 if above else 0)))


def sketches(rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts by group, rate (and length) and bin, of documents that pass the base rules: the mergeable sketch."""
    values = {r: F.col(_rate_column(r)) for r in RATES} | {_LENGTH: F.col(_LENGTH)}
    pairs = F.array(*[F.struct(F.lit(r).alias("rate"), _bin(c).alias("bin")) for r, c in values.items()])
    rows = rates.where("not base_failed").select(*keys, F.explode(pairs).alias("__x"))
    return rows.groupBy(*keys, F.col("__x.rate").alias("rate"), F.col("__x.bin").alias("bin")).agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame, keys: Sequence[str], reach: float = REACH) -> DataFrame:
    """Per group and rate: documents, and the least and the greatest rate that is kept."""
    by = Window.partitionBy(*keys, "rate")
    rows = sketch.withColumn("below", F.sum("n").over(by.orderBy("bin"))).withColumn("all", F.sum("n").over(by))
    at = lambda q: F.min(F.when(F.col("below") >= q * F.col("all"), F.col("bin")))
    rows = rows.groupBy(*keys, "rate").agg(F.max("all").alias("n"), at(0.1).alias("q10"), at(0.5).alias("q50"), at(0.9).alias("q90"))
    length = F.max(F.when(F.col("rate") == _LENGTH, _value(F.col("q50"), True))).over(Window.partitionBy(*keys))
    rows = rows.withColumn("length", length).where(F.col("rate") != _LENGTH)
    one_more = reduce(lambda c, r: c.when(F.col("rate") == r, RATES[r][1] * 1_000_000 / F.col("length")), RATES, F.when(F.lit(False), 0.0))
    # from the lower bound of one bin to the upper of another: a spread is never below what the sketch can tell
    low, high = _value(F.col("q10"), False), _value(F.col("q90"), True)
    down, up = _value(F.col("q50"), True) - low, high - _value(F.col("q50"), False)
    return rows.select(
        *keys,
        "rate",
        "n",
        F.when(F.col("rate").isin(*_TWO_SIDED), low - reach * F.greatest(down, one_more)).otherwise(0.0).alias("least"),
        (high + reach * F.greatest(up, one_more)).alias("most"),
    )


def _flat(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a group with a column for each rate's thresholds."""
    sides = [F.max(F.when(F.col("rate") == r, F.col(s))).alias(f"{s}_{r}") for r in RATES for s in ("least", "most")]
    return found.groupBy(*keys).agg(F.max("n").alias("n_group"), *sides)


def quality(
    docs: DataFrame,
    text: str = "text",
    keys: Sequence[str] = ("lang", "source"),
    keep: Sequence[str] | None = None,
    min_group: int = MIN_GROUP,
    reach: float = REACH,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with FEATURES, base_failed, kept and reasons (the rates beyond a threshold)."""
    results = (*FEATURES, "base_failed", "kept", "reasons")
    columns = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results]
    # the caller's columns under names of their own, so that none is taken for one of the operator's
    own = {c: f"__own_{i}" for i, c in enumerate(dict.fromkeys([*columns, *keys, text]))}
    source = docs.select(*[F.col(c).alias(n) for c, n in own.items()])
    on = [own[k] for k in keys]
    needed = [own[c] for c in dict.fromkeys([*columns, *keys])]
    rows = materialise(features(source, own[text], needed).withColumn("base_failed", base_failed()), "features")
    rates = with_rates(rows)
    sketch = materialise(sketches(rates, on), "sketches")
    wide = sketch.groupBy(on[0], "rate", "bin").agg(F.sum("n").alias("n"))
    everything = wide.groupBy("rate", "bin").agg(F.sum("n").alias("n")).withColumn("__one", F.lit(1))
    levels = [_flat(thresholds(sketch, on, reach), on), _flat(thresholds(wide, on[:1], reach), on[:1])]
    widest = _flat(thresholds(everything, ["__one"], reach), ["__one"]).first()  # one row
    sides = [f"{s}_{r}" for r in RATES for s in ("least", "most")]
    groups = rows.groupBy(*on).agg(F.count("*").alias("__rows"))
    for i, (level, by) in enumerate(zip(levels, (on, on[:1]))):
        right = level.select(*[F.col(k).alias(f"__{i}_{k}") for k in by], F.struct("n_group", *sides).alias(f"level{i}"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{i}_{k}")) for k in by])
        groups = groups.join(right, same, "left")
    of_all = [F.lit(widest["n_group"] if widest else None).cast("bigint").alias("n_group")]
    of_all += [F.lit(widest[s] if widest else None).cast("double").alias(s) for s in sides]
    enough = lambda i: F.when(F.col(f"level{i}.n_group") >= min_group, F.col(f"level{i}"))
    groups = groups.select(*on, F.coalesce(enough(0), enough(1), F.struct(*of_all)).alias("__limits"))
    groups = materialise(groups, "limits")
    joined = join_groups(rates, groups, on, groups.count(), F.xxhash64(*[F.col(f) for f in FEATURES], *needed))
    beyond = []
    for r in RATES:
        value = F.col(_rate_column(r))
        beyond.append(F.when((value < F.col(f"__limits.least_{r}")) | (value > F.col(f"__limits.most_{r}")), F.lit(r)))
    reasons = F.filter(F.array(*beyond), lambda x: x.isNotNull())
    return joined.select(
        *[F.col(own[c]).alias(c) for c in columns],
        *FEATURES,
        "base_failed",
        (~F.col("base_failed") & (F.size(reasons) == 0)).alias("kept"),
        reasons.alias("reasons"),
    )
