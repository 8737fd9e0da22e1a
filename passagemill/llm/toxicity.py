"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are runs of letters and digits, their first letters (short stems) and, over the whole of long runs and of
runs in scripts without spaces, all n-grams. The vocabulary holds every term of a bounded
sample of labelled texts; document frequencies are counted over all documents. The sample's
vectors form an inverted index: rare terms as lists of examples, frequent ones as blocks of
examples with the greatest weight of each term in each block. A document's lists are added up
first; of the blocks only those are added whose bound reaches the k-th best sum so far, so the result is
exact. The neighbours vote with weights that grow as the distance falls;
a monotone curve, fitted to votes of the examples about each other, turns votes into
probabilities at the label rate of all labelled rows.

Null and empty texts, and texts without a term of the vocabulary, get the rate of
such examples. Ties in cosine go to the smaller example id. Repeated rows are scored
alike; several labels of one id count as toxic if any is. Null labels are ignored. Without labels the score is 0,
with one class it is that class's. An empty table stays empty. Extra columns pass
through; a result column takes the place of one of its name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, materialise, schema_of, text_slices, texts_of

#: Labelled texts of each class in the index.
MAX_EXAMPLES = 2000
STEMS = (4, 5, 6, 7, 8)
BLOCK = 64
#: Terms that this share of the examples has are held in blocks, at most so many; all others as lists.
HEAD_SHARE, HEAD_TERMS = 0.07, 1200
#: Documents that are scored at a time, and whose lists are added up at a time.
QUERIES, LISTS_AT_ONCE = 128, 8
#: Words that a task remembers with their terms.
CACHE_WORDS = 120_000
NEIGHBOURS = 15
SEED = 3
#: Runs of more letters than this, and runs in a script without spaces, bring their n-grams as well.
LONG_RUN = 24
GRAMS, SPACELESS_GRAMS = STEMS, (1, 2, 3, 4)
#: ASCII letters and digits in lower case, all other ASCII as a space; bytes of other characters stay.
_TABLE = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256))
_RUN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_SPACELESS = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


def words_of(text: bytes) -> list[bytes]:
    """Pieces between ASCII characters that are neither letters nor digits, in lower case."""
    return text.translate(_TABLE).split()


def terms_of(word: bytes) -> Iterator[bytes]:
    """Runs of letters, marks and digits, their stems, which end in ``*``, and the n-grams over the whole of long runs.

    N-grams are terms like words, so that a word is found inside a run without spaces.
    """
    for s in [word.decode()] if word.isascii() else _RUN.findall(word.decode("utf-8", "ignore").lower()):
        yield s.encode()
        for n in STEMS:
            if len(s) > n:
                yield s[:n].encode() + b"*"
        grams = () if word.isascii() and len(s) <= LONG_RUN else SPACELESS_GRAMS if _SPACELESS.search(s) else GRAMS if len(s) > LONG_RUN else ()
        for n in grams:
            if len(s) > n:
                for i in range(len(s) - n + 1):
                    yield s[i : i + n].encode()


_KEY_BYTES = 24
#: Which bits of a key's three numbers belong to a word of 0 to 24 bytes.
_BITS = np.array([[(1 << (8 * min(8, max(0, n - 8 * i)))) - 1 for i in range(3)] for n in range(_KEY_BYTES + 1)], np.uint64)
_HIGH = np.uint64(0x8080808080808080)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _hash(keys: np.ndarray, stem: np.ndarray | int) -> np.ndarray:
    h = keys[:, 0] * _MIX[0]
    h = (h ^ (h >> np.uint64(29)) ^ keys[:, 1]) * _MIX[1]
    h = (h ^ (h >> np.uint64(32)) ^ keys[:, 2]) * _MIX[2]
    return (h ^ (h >> np.uint64(31)) ^ np.asarray(stem, np.uint64)) * _MIX[3]


class Vocabulary:
    """Numbers of the terms, and the terms of whole slices of text.

    Words of ASCII letters and digits, and their stems, are keys of 24 bytes that are looked up side by side in one table by
    their hash, and compared; other words go through ``terms_of`` one by one and are remembered.
    """

    def __init__(self, terms: Sequence[bytes]):
        self.terms, self.number, self.cache = len(terms), {t: i for i, t in enumerate(terms)}, {}
        short = [(i, t) for i, t in enumerate(terms) if t.isascii() and len(t) <= _KEY_BYTES]
        self.at = np.array([i for i, _ in short], np.int64)
        stem = np.array([t.endswith(b"*") for _, t in short], np.uint8)
        raw = b"".join([t.rstrip(b"*").ljust(_KEY_BYTES, b"\0") for _, t in short])
        self.keys = np.frombuffer(raw, "<u8").reshape(-1, 3)
        self.stem = stem
        bits = max(8, int(len(short) * 4).bit_length())
        self.shift, self.table = np.uint64(64 - bits), np.full((1 << bits) + len(short) + 1, -1, np.int32)
        left, place = np.arange(len(short), dtype=np.int32), (_hash(self.keys, stem) >> self.shift).astype(np.int64)
        while len(left):  # the first of those that want a free place gets it, the others look one further
            free = self.table[place] < 0
            _, first = np.unique(place[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.table[place[won]] = left[won]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, place = left[rest], place[rest] + 1

    def lookup(self, keys: np.ndarray, stem: np.ndarray) -> np.ndarray:
        """Number of each term, -1 for those that the vocabulary lacks."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        place = (_hash(keys, stem) >> self.shift).astype(np.int64)
        while len(left):
            found = self.table[place]
            some = np.flatnonzero(found >= 0)
            left, found, place = left[some], found[some], place[some]
            same = (self.keys[found] == keys[left]).all(1) & (self.stem[found] == stem[left])
            out[left[same]] = self.at[found[same]]
            left, place = left[~same], place[~same] + 1
        return out

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of the vocabulary's terms, by text and term."""
        none = np.zeros(0, np.int64)
        joined = b" ".join(texts).translate(_TABLE)
        if not self.terms or not joined.strip():
            return none, none, none
        data = np.frombuffer(joined + bytes(_KEY_BYTES), np.uint8)
        inside = data[: len(joined)] != 32
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        start, size = edges[::2], edges[1::2] - edges[::2]
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
        short = np.flatnonzero(size <= min(LONG_RUN, _KEY_BYTES))
        keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, _KEY_BYTES)[start[short]]).view("<u8") & _BITS[size[short]]
        h = _hash(keys, 0)
        order = np.argsort(h)
        fresh = np.diff(h[order], prepend=h[order[:1]] + np.uint64(1)) != 0
        first, which = order[fresh], np.empty(len(h), np.int64)
        which[order] = np.cumsum(fresh) - 1
        if (keys[first][which] != keys).any():  # two words of one hash
            _, first, which = np.unique(keys, axis=0, return_index=True, return_inverse=True)
            which = which.reshape(-1)
        # plain words come first, then those with other characters, then long ones
        ascii_only = ((keys[first] & _HIGH) == 0).all(1)
        place = np.empty(len(first), np.int64)
        place[ascii_only] = np.arange(ascii_only.sum())
        place[~ascii_only] = ascii_only.sum() + np.arange((~ascii_only).sum())
        word = np.empty(len(start), np.int64)
        word[short] = place[which]
        lists, lengths = self._plain(keys[first[ascii_only]], size[short[first[ascii_only]]])
        at = short[first[~ascii_only]]
        more = [self._odd(joined[a : a + n]) for a, n in zip(start[at].tolist(), size[at].tolist())]
        numbers: dict[bytes, int] = {}
        for i in np.flatnonzero(size > min(LONG_RUN, _KEY_BYTES)).tolist():
            w = joined[start[i] : start[i] + size[i]]
            if w not in numbers:
                numbers[w] = len(lengths) + len(more)
                more.append(self._odd(w))
            word[i] = numbers[w]
        lists = np.concatenate([lists, np.array([t for ts in more for t in ts], np.int64)])
        lengths = np.concatenate([lengths, np.array([len(ts) for ts in more], np.int64)])
        pairs, n = np.unique(text * len(lengths) + word, return_counts=True)
        text, word = np.divmod(pairs, len(lengths))
        # each word's terms one after another
        many = lengths[word]
        ends = np.cumsum(many)
        of = np.repeat((np.cumsum(lengths) - lengths)[word] - ends + many, many) + np.arange(ends[-1])
        key = np.repeat(text, many) * self.terms + lists[of]
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        text, term = np.divmod(key[first], self.terms)
        return text, term, np.add.reduceat(np.repeat(n, many)[order], first) if len(first) else none

    def _plain(self, keys: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms of plain words one after another, and how many each has: the same as ``terms_of`` gives."""
        found = np.full((len(keys), 1 + len(STEMS)), -1, np.int64)
        found[:, 0] = self.lookup(keys, np.zeros(len(keys), np.uint8))
        starts = [np.flatnonzero(size > n) for n in STEMS]
        stems = np.zeros((sum(map(len, starts)), 3), np.uint64)
        stems[:, 0] = np.concatenate([keys[at, 0] & _BITS[n, 0] for at, n in zip(starts, STEMS)])
        # words share their starts
        short, which = np.unique(stems[:, 0], return_inverse=True)
        own = np.zeros((len(short), 3), np.uint64)
        own[:, 0] = short
        got = self.lookup(own, np.ones(len(own), np.uint8))[which]
        for i, at in enumerate(starts):
            found[at, 1 + i], got = got[: len(at)], got[len(at) :]
        return found[found >= 0], (found >= 0).sum(1)

    def _odd(self, word: bytes) -> tuple[int, ...]:
        at = self.cache.get(word)
        if at is None:
            at = tuple([self.number[t] for t in terms_of(word) if t in self.number])
            if len(word) <= 64:  # of longer ones, the terms aren't held
                if len(self.cache) > CACHE_WORDS:
                    self.cache.clear()
                self.cache[word] = at
        return at


def _kept_vocabulary(shipped: dict) -> Vocabulary:
    """The vocabulary of what a worker process was sent, made once and kept beside it for all its tasks."""
    return shipped.get("vocabulary") or shipped.setdefault("vocabulary", Vocabulary(shipped["terms"]))


def examples(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, chosen: Column, limit: int) -> tuple[DataFrame, float | None]:
    """(id, y, text) of at most ``limit`` labelled texts of each class, and the share of toxic labels."""
    own = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y")).where("y is not null and id is not null")
    own = own.where(chosen).groupBy("id").agg(F.max("y").cast("int").alias("y"))
    share = own.agg(F.avg("y")).first()[0]
    by = F.xxhash64(F.lit(SEED), F.col("id"))
    ids = own.where("y = 1").orderBy(by, "id").limit(limit).unionByName(own.where("y = 0").orderBy(by, "id").limit(limit))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).where("t is not null")
    rows = rows.join(F.broadcast(ids), "id").groupBy("id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    return materialise(rows, "examples"), share


def all_terms(found: DataFrame) -> list[bytes]:
    """Every term of the examples, in order."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "t"):
                own = {x for t in texts_of(part.column("t")) for w in set(words_of(t)) for x in terms_of(w)}
                yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary())], ["term"])

    return sorted(found.select("t").mapInArrow(run, "term binary").distinct().toArrow().column("term").to_pylist())


def document_frequencies(docs: DataFrame, text: str, terms: list[bytes]) -> tuple[np.ndarray, int]:
    """Documents with each term, and all documents: over the whole table."""
    shipped = docs.sparkSession.sparkContext.broadcast({"terms": terms})

    def run(batches):
        vocabulary = _kept_vocabulary(shipped.value)
        df = np.zeros(len(shipped.value["terms"]) + 1, np.int64)
        for batch in batches:
            for part in text_slices(batch, "t", 1 << 20):
                _, terms, _ = vocabulary.counts(texts_of(part.column("t")))
                df[:-1] += np.bincount(terms, minlength=len(df) - 1)
                df[-1] += len(part)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "n"])

    rows = docs.select(F.col(text).alias("t")).mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(terms) + 1, np.int64)
    df[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return df[:-1], int(df[-1])


def vectors(text: np.ndarray, term: np.ndarray, n: np.ndarray, idf: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, weight) with unit length for each of ``texts`` texts that has a term."""
    w = (1 + np.log(n)) * idf[term]
    norm = np.sqrt(np.bincount(text, w * w, texts))
    return text, term, w / norm[text]


def _listed(text: np.ndarray, term: np.ndarray, w: np.ndarray, texts: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Terms and weights of each text."""
    cuts = np.searchsorted(text, np.arange(1, texts))
    return list(zip(np.split(term, cuts), np.split(w, cuts))) if texts else []


def build_index(vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> tuple:
    """Lists of (example, weight) by term, and blocks of the frequent terms with their greatest weights.

    (number of examples, where each term's list starts, its examples, their weights, each term's
    row in the blocks or -1, blocks of terms by examples, greatest weights of terms by blocks)
    """
    n = len(vectors)
    terms = np.concatenate([np.zeros(0, np.int64), *[t for t, _ in vectors]])
    weights = np.concatenate([np.zeros(0), *[w for _, w in vectors]]).astype(np.float32)
    who = np.repeat(np.arange(n, dtype=np.int32), [len(t) for t, _ in vectors])
    share = np.bincount(terms, minlength=n_terms)
    often = np.argsort(-share, kind="stable")[:HEAD_TERMS]
    often = np.sort(often[share[often] > HEAD_SHARE * n])
    row = np.full(n_terms, -1, np.int32)
    row[often] = np.arange(len(often))
    inside = row[terms] >= 0
    head = np.zeros((len(often), n), np.float32)
    head[row[terms[inside]], who[inside]] = weights[inside]
    blocks = [np.ascontiguousarray(head[:, b : b + BLOCK]) for b in range(0, n, BLOCK)]
    most = np.array([b.max(1) for b in blocks], np.float64).T.reshape(len(often), len(blocks))  # of the weights as they are stored, so that it is a bound
    order = np.flatnonzero(~inside)
    order = order[np.argsort(terms[order], kind="stable")]
    starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
    return n, starts, who[order], weights[order], row, blocks, most


def nearest(index: tuple, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(cosine, example) of the k nearest examples of each query, best first; -1 where there are fewer.

    Cosines are rounded to 12 digits before they are ranked, so ties don't depend on batches.
    """
    found = [(np.zeros((0, k)), np.zeros((0, k), np.int64))]
    for at in range(0, len(queries), QUERIES):  # few at a time: they are copied
        some = queries[at : at + QUERIES]
        q = np.repeat(np.arange(len(some)), [len(t) for t, _ in some])
        found.append(nearest_of(index, q, np.concatenate([t for t, _ in some]), np.concatenate([w for _, w in some]), len(some), k))
    return np.concatenate([c for c, _ in found]), np.concatenate([w for _, w in found])


def nearest_of(index: tuple, q: np.ndarray, t: np.ndarray, w: np.ndarray, m: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` for ``m`` queries as rows (query, term, weight) in order."""
    cos, who = np.full((m, k), -1.0), np.full((m, k), -1, np.int64)
    if index[0]:
        for at in range(0, m, QUERIES):
            part, (a, b) = slice(at, at + QUERIES), np.searchsorted(q, [at, at + QUERIES])
            _nearest(index, q[a:b] - at, t[a:b], w[a:b], min(QUERIES, m - at), k, cos[part], who[part])
    return cos, who


def _nearest(index: tuple, q: np.ndarray, t: np.ndarray, w: np.ndarray, m: int, k: int, cos: np.ndarray, who: np.ndarray) -> None:
    n, starts, lists, weights, row, blocks, most = index
    dense = np.zeros((m, most.shape[0]))
    inside = row[t] >= 0
    dense[q[inside], row[t[inside]]] = w[inside]
    found = np.empty((m, n))
    for at in range(0, m, LISTS_AT_ONCE):
        a, b = np.searchsorted(q, [at, at + LISTS_AT_ONCE])
        # all lists of these queries: the places of each one after another
        sizes = starts[t[a:b] + 1] - starts[t[a:b]]
        ends = np.cumsum(sizes)
        place = np.repeat((starts[t[a:b]] - ends + sizes).astype(np.int32), sizes)
        place += np.arange(len(place), dtype=np.int32)
        key = np.repeat(((q[a:b] - at) * n).astype(np.int32), sizes)
        key += lists[place]
        share = np.repeat(w[a:b], sizes)
        share *= weights[place]
        some = min(LISTS_AT_ONCE, m - at)
        found[at : at + some] = np.bincount(key, share, some * n).reshape(some, n)
    # weights aren't negative: the k-th best sum so far is a bound from below, a block's greatest sum and weights one from above
    least = np.partition(found, n - k, 1)[:, n - k] if n > k else np.zeros(m)
    width = range(0, n, BLOCK)
    above = np.maximum.reduceat(found, np.array(width), axis=1) + dense @ most + 1e-9
    go = above >= least[:, None]
    for b, first in enumerate(width):
        rows = np.flatnonzero(go[:, b])
        if len(rows):
            found[rows, first : first + BLOCK] += dense[rows] @ blocks[b]
        found[~go[:, b], first : first + BLOCK] = -1.0
    found = np.round(found, 12)
    few = min(k, n)
    bound = np.partition(found, n - few, 1)[:, n - few]
    for i in range(m):
        ids = np.flatnonzero(found[i] >= max(bound[i], 1e-12))
        ids = ids[np.lexsort((ids, -found[i, ids]))][:k]
        cos[i, : len(ids)], who[i, : len(ids)] = found[i, ids], ids


def votes(cos: np.ndarray, who: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float) -> np.ndarray:
    """Share of toxic among the neighbours, weighted by closeness and drawn to ``prior``."""
    there = who >= 0
    w = np.where(there, np.maximum(cos, 0) / (1.05 - np.minimum(cos, 1)), 0.0) * np.where(there, weight[who], 0.0)
    return ((w * np.where(there, y[who], 0)).sum(1) + 0.2 * prior) / (w.sum(1) + 0.2)


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a non-decreasing curve through weighted means: pool adjacent violators."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist()):
        pools.append([a * c, b * c, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def train(
    docs: DataFrame,
    labels: DataFrame,
    chosen: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    max_examples: int = MAX_EXAMPLES,
    k: int = NEIGHBOURS,
) -> dict:
    """Index, labels and calibration, as plain arrays of bounded size. ``chosen``: over column ``id``, the labels to learn from."""
    found, share = examples(docs, labels, text, doc_id, label, chosen, max_examples)
    model = {"terms": [], "k": k, "blank": float(share or 0.0), "prior": float(share or 0.0)}
    if found.select("y").distinct().count() < 2:
        return model
    terms = all_terms(found)
    if not terms:
        return model
    df, n = document_frequencies(docs, text, terms)
    idf = np.log((1 + n) / (1 + df)) + 1
    shipped = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        vocabulary = Vocabulary(shipped.value)
        for batch in batches:
            for part in text_slices(batch, "t"):
                text, term, n = vocabulary.counts(texts_of(part.column("t")))
                ends = pa.array(np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, n)]
                yield pa.RecordBatch.from_arrays([part.column("id").cast(pa.string()), part.column("y"), *lists], ["id", "y", "terms", "counts"])

    rows = []
    for batch in found.mapInArrow(run, "id string, y int, terms array<int>, counts array<int>").toArrow().to_batches():
        ends = np.asarray(batch.column("terms").offsets)
        term, counts = (batch.column(c).flatten().to_numpy() for c in ("terms", "counts"))
        text = np.repeat(np.arange(len(batch)), np.diff(ends))
        listed = _listed(*vectors(text, term, counts, idf, len(batch)), len(batch))
        rows += list(zip(batch.column("id").to_pylist(), batch.column("y").to_pylist(), listed))
    ones = sum(y for _, y, _ in rows)
    weight_of = (1 - share) / max(1, len(rows) - ones), share / max(1, ones)
    blank = [(y, weight_of[y]) for _, y, (t, _) in rows if not len(t)]
    full = [r for r in rows if len(r[2][0])]
    # examples with the same strongest frequent term stand together, which keeps the blocks' bounds low
    common = np.bincount(np.concatenate([np.zeros(0, np.int64), *[r[2][0] for r in full]]), minlength=len(terms)) > HEAD_SHARE * len(full)
    full.sort(key=lambda r: (int(r[2][0][np.argmax(r[2][1] * common[r[2][0]])]), r[0]))
    y = np.array([r[1] for r in full] or [0])
    weight = np.array([weight_of[a] for a in y.tolist()]) * len(rows)
    index = build_index([r[2] for r in full], len(terms))
    # votes of the others about each example
    cos, who = nearest(index, [r[2] for r in full], k + 1)
    own = who == np.arange(len(full))[:, None]
    own[~own.any(1), -1] = True
    votes_of = votes(cos[~own].reshape(-1, k), who[~own].reshape(-1, k), y, weight, share) if full else np.zeros(0)
    xs, ys = monotone(votes_of, y[: len(votes_of)], weight[: len(votes_of)]) if full else (np.zeros(0), np.zeros(0))
    return model | {
        "terms": terms,
        "idf": idf,
        "index": index,
        "ids": [r[0] for r in full],
        "y": y,
        "weight": weight,
        "blank": (sum(a * w for a, w in blank) + share * 1e-3) / (sum(w for _, w in blank) + 1e-3),
        "curve": (xs, ys),
    }


def score(model: dict, texts: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores, and the neighbours' cosines and numbers."""
    k = model["k"]
    out = np.full(len(texts), model["blank"])
    if not model["terms"]:
        return out, np.full((len(texts), k), -1.0), np.full((len(texts), k), -1, np.int64)
    text, term, w = vectors(*vocabulary.counts(texts), model["idf"], len(texts))
    cos, who = nearest_of(model["index"], text, term, w, len(texts), k)
    rows = np.unique(text)
    near = votes(cos[rows], who[rows], model["y"], model["weight"], model["prior"])
    xs, ys = model["curve"]
    fitted = np.interp(near, xs, ys) if len(xs) else near
    # the curve is flat in places; a little of the vote keeps the order of documents
    out[rows] = np.where(who[rows, 0] < 0, model["blank"], 0.99 * fitted + 0.01 * near)
    return np.clip(out, 0, 1), cos, who


def toxicity(docs: DataFrame, model: dict, text: str = "text", keep: Sequence[str] | None = None, evidence: bool = True) -> DataFrame:
    """``docs`` (or its columns ``keep``) with score, predicted and, as evidence, the neighbours (id, toxic, cosine)."""
    results = ("score", "predicted", *["neighbours"] * evidence)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in results]
    source = docs.select(*keep) if text in keep else docs.select(*keep, text)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    fields = [("score", "double"), ("predicted", "int")]
    if evidence:
        fields.append(("neighbours", "array<struct<id:string,toxic:int,cosine:double>>"))
    def run(batches):
        known = shipped.value
        vocabulary, names = _kept_vocabulary(known), pa.array(known.get("ids", []), pa.string())
        toxic = np.asarray(known.get("y", []), np.int32)
        for batch in batches:
            for part in text_slices(batch, text, 1 << 20):
                s, cos, who = score(known, texts_of(part.column(text)), vocabulary)
                arrays = [*kept(part, keep), pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
                if evidence:
                    there = who >= 0  # the first of each row
                    ends = pa.array(np.concatenate([[0], np.cumsum(there.sum(1))]).astype(np.int32))
                    near = [names.take(pa.array(who[there])), pa.array(toxic[who[there]]), pa.array(cos[there])]
                    arrays.append(pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(near, ["id", "toxic", "cosine"])))
                yield pa.RecordBatch.from_arrays(arrays, [*keep, *[f for f, _ in fields]])

    return source.mapInArrow(run, schema_of(docs, keep, *fields))
