"""Ranked lexical search: the best documents of each item, by buckets of vector length.

A document is a vector of integer impacts over the terms that any item has, an item one of integer
weights. Both are scaled by the root of the term's weight, which leaves every product as it is
and makes the lengths of documents small where their terms are common. Documents are ordered by
length and cut into buckets, the longest first. By Cauchy-Schwarz no document of a bucket can score more
than the item's length times the bucket's greatest, so a bucket that cannot reach the item's k-th score
so far is passed over. Within a bucket the products over the item's heaviest coordinates are added up, and
Cauchy-Schwarz over the others bounds what may still come; what survives is scored again in integers.
The bounds are in floating point with a margin and only ever leave out what scores less than the k-th, so the
result is exact, ties included.

The longest documents of all are searched first; what they give is the threshold that all tasks start from.
Distinct texts of items are searched in blocks of bounded size, one block at a time, each
over all documents; items with equal texts share their result.

Terms are runs of ASCII letters (lower-cased), digits and all characters beyond ASCII. Null and empty
texts have none: such items have no result, and such documents count nowhere. Documents of equal
score go by id, those without one last; repeated rows are ranked each. Empty tables give no rows. Result
columns are the item's id, rank, the document's id and score; other columns are not carried along.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import drop_path, materialise, scratch_path, text_slices, texts_of

#: Bytes of item texts that are searched at a time.
BLOCK_BYTES = 2 << 20
#: Documents whose vectors are looked at together.
BUCKET_ROWS = 2048
#: So many of the longest vectors (and all as long as the last) give the first thresholds.
SEED_ROWS = 4096
#: Documents a task orders by length, about.
RANGE_ROWS = 50_000
#: The heaviest coordinates of an item that hold this part of its squared length are added up before the bound.
FOCUS = 0.7
#: Bounds are raised by this part, far above their rounding errors.
MARGIN = 1e-9

_KEEP = bytes(
    c | 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """A block of item texts as sparse vectors over their common vocabulary."""

    def __init__(self, texts: Sequence[bytes]):
        counts = [Counter(terms_of(t)) for t in texts]
        self.vocabulary: dict[bytes, int] = {}
        for c in counts:
            for term in c:
                self.vocabulary.setdefault(term, len(self.vocabulary))
        self.counts = [(np.array([self.vocabulary[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in counts]

    def weighted(self, weights: np.ndarray) -> list[tuple]:
        """Of each item: terms, heaviest first, integer weights, scaled coordinates, length, number of focus terms and length of the others."""
        out = []
        for terms, repeats in self.counts:
            used = weights[terms] > 0
            terms, repeats = terms[used], repeats[used]
            scaled = repeats * np.sqrt(weights[terms])
            order = np.argsort(-scaled, kind="stable")
            terms, exact, scaled = terms[order], (weights[terms] * repeats)[order], scaled[order]
            squares = np.cumsum(scaled * scaled)
            whole = squares[-1] if len(squares) else 0.0
            focus = int(np.searchsorted(squares, FOCUS * whole)) + 1 if len(squares) else 0
            rest = math.sqrt(max(0.0, whole - squares[focus - 1])) if focus else 0.0
            out.append((terms, exact, scaled, math.sqrt(whole), focus, rest))
        return out


def _counter(shared, doc_id: str, text: str):
    """Documents to (id, n, term, tf): their number of terms, and those of the vocabulary with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        known = vocabulary.keys()
        for batch in batches:
            for piece in text_slices(batch, text):
                sizes, ends, terms, tfs = [], [0], [], []
                for blob in texts_of(piece.column(text)):
                    words = terms_of(blob)
                    counts = Counter(words)
                    found = known & counts.keys()
                    terms.extend(map(vocabulary.__getitem__, found))
                    tfs.extend(map(counts.__getitem__, found))
                    sizes.append(len(words))
                    ends.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, t)) for x, t in ((terms, pa.int32()), (tfs, pa.int64()))]
                rows = pa.RecordBatch.from_arrays([piece.column(doc_id), pa.array(sizes, pa.int64()), *lists], ["id", "n", "term", "tf"])
                yield rows.filter(pa.array(np.array(sizes) > 0))

    return count


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after another, and where each row starts (one more at the end)."""
    starts = np.asarray(column.offsets, np.int64)
    return np.asarray(column.values)[starts[0] : starts[-1]], starts - starts[0]


def _impacts(shared, n_docs: int, n_terms: int):
    """(id, n, term, tf) to (id, length, term, impact), over terms that weigh anything."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            term, starts = _flat(batch.column("term"))
            tf, _ = _flat(batch.column("tf"))
            # the product may pass 64 bits, so it is made of Python's numbers
            mean = np.array([75 + (25 * n * n_docs) // n_terms for n in batch.column("n").to_pylist()], np.int64)
            row = np.repeat(np.arange(len(batch)), np.diff(starts))
            impact = (1_000_000_000 * tf) // (1000 * tf + 12 * mean[row])
            used = weights[term] > 0
            row, term, impact = row[used], term[used], impact[used]
            squares = np.bincount(row, weights[term] * impact.astype(np.float64) ** 2, len(batch))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(batch)))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (term, impact)]
            rows = pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.sqrt(squares)), *lists], ["id", "length", "term", "impact"])
            yield rows.filter(pa.array(squares > 0))

    return vectors


class Best:
    """The k best of one item so far, by score and then id; ``least`` is what a further one must score."""

    def __init__(self, k: int, least: int):
        self.k, self.least, self.rows = k, least, []

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows += [(-int(s), i is None, i) for s, i in zip(scores, ids) if s > 0]
        self.rows.sort(key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.least = max(self.least, -self.rows[-1][0])


def search_bucket(items: list[tuple], best: list[Best], length: np.ndarray, term: np.ndarray, impact: np.ndarray, starts: np.ndarray,
                  ids: pa.Array, weights: np.ndarray, scratch: np.ndarray) -> tuple[int, int]:
    """Search all items in one bucket; gives the number of items that looked inside and of documents that were scored."""
    greatest = length.max()
    alive = [i for i, q in enumerate(items) if q[3] * greatest * (1 + MARGIN) >= max(best[i].least, MARGIN)]
    if not alive:
        return 0, 0
    row = np.repeat(np.arange(len(length)), np.diff(starts))
    scaled = impact * np.sqrt(weights[term])
    by_term = np.argsort(term, kind="stable")
    term_at, row_at, scaled_at = term[by_term], row[by_term], scaled[by_term]
    squares, scored = length * length, 0
    for i in alive:
        terms, exact, coordinates, _, focus, rest = items[i]
        least = best[i].least
        partial, seen = np.zeros(len(length)), np.zeros(len(length))
        lo, hi = np.searchsorted(term_at, terms[:focus]), np.searchsorted(term_at, terms[:focus], side="right")
        for a, b, q in zip(lo, hi, coordinates):
            at, values = row_at[a:b], scaled_at[a:b]
            partial[at] += q * values
            seen[at] += values * values
        # a little is added to what is left of the length, so that cancelled digits can't lower the bound
        left = np.sqrt(np.maximum(squares - seen, 0.0) + MARGIN * squares)
        bound = (partial + rest * left) * (1 + MARGIN)
        rows = np.flatnonzero((bound >= least) & (bound > 0))
        if not len(rows):
            continue
        scored += len(rows)
        scratch[terms] = exact
        sizes = starts[rows + 1] - starts[rows]
        first = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(starts[rows] - first, sizes)
        scores = np.add.reduceat(scratch[term[at]] * impact[at], first)
        scratch[terms] = 0
        won = np.flatnonzero((scores >= least) & (scores > 0))
        if len(won):
            best[i].add(scores[won], ids.take(pa.array(rows[won])).to_pylist())
    return len(alive), scored


def _searcher(shared, k: int, kind: pa.DataType):
    """Vectors, longest first, to the k best (item, id, score) of this task; ``shared``: items, weights, thresholds."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, least = shared.value
        best = [Best(k, int(t)) for t in least]
        scratch = np.zeros(len(weights), np.int64)
        for batch in batches:
            for at in range(0, len(batch), BUCKET_ROWS):
                piece = batch.slice(at, BUCKET_ROWS)
                term, starts = _flat(piece.column("term"))
                impact, _ = _flat(piece.column("impact"))
                search_bucket(items, best, np.asarray(piece.column("length")), term, impact.astype(np.int64), starts, piece.column("id"), weights, scratch)
        found = [(i, r[2], -r[0]) for i, b in enumerate(best) for r in b.rows]
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], kind), pa.array(columns[2], pa.int64())], ["item", "id", "score"]
        )

    return search


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, texts: Sequence[bytes], doc_id: str, text: str, k: int) -> DataFrame:
    """(item, id, score, rank) of the k best documents for each of the texts, as a stored table."""
    spark = docs.sparkSession
    block = Items(texts)
    kind = docs.schema[doc_id].dataType
    arrays = lambda of, what: T.StructType([T.StructField("id", kind), T.StructField(*of), *[T.StructField(n, T.ArrayType(t)) for n, t in what]])

    counted = arrays(("n", T.LongType()), (("term", T.IntegerType()), ("tf", T.LongType())))
    path = scratch_path(spark, "counts")
    vocabulary = spark.sparkContext.broadcast(block.vocabulary)
    docs.select(doc_id, text).mapInArrow(_counter(vocabulary, doc_id, text), counted).write.parquet(path)
    counts = spark.read.schema(counted).parquet(path)
    n_docs, n_terms = counts.agg(F.count("*"), F.sum("n")).first()
    weights = np.zeros(len(block.vocabulary), np.int64)
    # one row a term of the block
    for term, df in counts.select(F.explode("term").alias("term")).groupBy("term").count().collect():
        weights[term] = weight(n_docs, df)

    measured = arrays(("length", T.DoubleType()), (("term", T.IntegerType()), ("impact", T.IntegerType())))
    vectors = counts.mapInArrow(_impacts(spark.sparkContext.broadcast(weights), n_docs, n_terms), measured)
    ranges = max(1 + n_docs // RANGE_ROWS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # equal lengths, such as those of copies, are dealt by a hash of the id
    vectors = vectors.withColumn("salt", F.xxhash64("id")).repartitionByRange(int(ranges), F.desc("length"), "salt")
    by_length = scratch_path(spark, "by-length")
    vectors.drop("salt").sortWithinPartitions(F.desc("length")).write.parquet(by_length)
    vectors = spark.read.schema(measured).parquet(by_length)

    items = block.weighted(weights)
    hit = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("id", kind), T.StructField("score", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_type

    def searched(rows: DataFrame, least: list[int]) -> DataFrame:
        shared = spark.sparkContext.broadcast((items, weights, least))
        return rows.mapInArrow(_searcher(shared, k, to_arrow_type(kind)), hit)

    longest = vectors.select("length").orderBy(F.desc("length")).limit(SEED_ROWS).agg(F.min("length")).first()[0]
    if longest is None:
        first = rest = vectors.limit(0)
    else:
        first, rest = vectors.where(F.col("length") >= longest), vectors.where(F.col("length") < longest)
    seeds = materialise(_ranked(searched(first, [0] * len(items)), k), "seeds")
    least = [0] * len(items)
    for r in seeds.where(F.col("rank") == k).collect():  # one row an item
        least[r["item"]] = r["score"]
    # a document shorter than this reaches no item's threshold, and row groups of such are not read
    reach = min((t / q[3] for t, q in zip(least, items) if q[3] > 0), default=0.0)
    others = searched(rest.where(F.col("length") >= reach * (1 - 2 * MARGIN)), least)
    found = materialise(_ranked(seeds.drop("rank").unionByName(others), k), "ranked")
    drop_path(spark, path)
    drop_path(spark, by_length)
    return found


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    text: str = "text",
    doc_id: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item, rank, doc_id, score): the ``k`` documents that score highest for every item, those above 0.

    Scores are BM25 in 64-bit integers; see :func:`weight` and :func:`_impacts`.
    """
    asked = items.select(F.col(item).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("item_text"))
    texts = materialise(asked.select("item_text").where("item_text <> ''").distinct(), "item-texts")
    volume = texts.agg(F.sum(F.octet_length("item_text") + 64)).first()[0] or 0
    blocks = 1 + int(volume // block_bytes)
    number = F.pmod(F.xxhash64("item_text"), F.lit(blocks))
    out = None
    for b in range(blocks):
        block = [r[0] for r in texts.where(number == b).sort("item_text").collect()]
        found = _search_block(docs, [t.encode() for t in block], doc_id, text, k)
        numbered = docs.sparkSession.createDataFrame(list(enumerate(block)), "item int, item_text string")
        hits = found.join(F.broadcast(numbered), "item")
        # at most k rows a text of the block
        answers = asked.join(F.broadcast(hits), "item_text").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        out = answers if out is None else out.unionByName(answers)
    return out.withColumnsRenamed({"item_id": item, "doc_id": doc_id}) if item.lower() != doc_id.lower() else out
