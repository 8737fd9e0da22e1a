"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; where five bits of it are zero a chunk ends
(never inside a character). The bits depend on the last 16 bytes only, so equal passages
are cut alike wherever they stand, and an insertion changes only the chunks it touches.
Chunks are deduplicated by a 128-bit digest: the first in order of document and place stays.
Neighbouring chunks that occur in an earlier document make up a run; runs of at least
MIN_BYTES are reported, shorter ones (single common words or phrases) are let stand.
``whole_passages`` cuts chunks over MAX_CHUNK once more and lets each run grow byte by byte to the
passage's ends before its length is tested.

Null and empty texts have no chunks. ``repeated_passages`` reports every occurrence but the first in
order of id, row and place, also inside one text and among rows with the same id or none.
``substring_duplicates`` compares documents only: rows with the same id are one
document, whose own repeats aren't reported. Ids must be whole numbers, or texts of such; a null id comes after all others. An
empty table gives no rows. Other columns don't matter. Texts of any length are
cut whole; a text without a cut is one chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, schema_of, text_slices, texts_of

#: Bits of the hash that must be zero: chunks of 32 bytes on average.
CUT_BITS = 5
#: Bytes that decide about a cut.
MEMORY = 16
#: Least length of a reported run.
MIN_BYTES = 100
#: Longest chunk where passages are followed to their ends.
MAX_CHUNK = 160
#: Copies of a chunk beyond which it counts as hot, and the share of all chunks that a hot one has at least.
HOT_COPIES, HOT_SHARE = 10_000, 50_000
SEED = 19

_GEAR = np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)


def _hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash h = 2 h + gear(byte) modulo 2^32 after each byte; its bits below MEMORY depend on the last MEMORY bytes only."""
    h = _GEAR[data]
    width = 1
    while width < MEMORY:  # the hash of twice the bytes, from two of half of them
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h, width = more, 2 * width
    return h


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    return np.flatnonzero((h & np.uint32(((1 << bits) - 1) << (MEMORY - bits))) == 0) + 1


def cuts(data: np.ndarray) -> np.ndarray:
    """Places where a chunk ends (the next one's first byte), by the gear hash."""
    return _places(_hashes(data), CUT_BITS)


def _bounded(data: np.ndarray, h: np.ndarray, edges: np.ndarray, usable, longest: int) -> np.ndarray:
    """``edges`` with longer chunks cut by ever fewer bits of the hash, and by length where no bit differs."""
    for bits in range(CUT_BITS - 1, 0, -1):
        long = np.diff(edges) > longest
        if not long.any():
            return edges
        found = usable(_places(h, bits))
        edges = np.union1d(edges, found[long[np.searchsorted(edges, found, side="right") - 1]])
    long = np.flatnonzero(np.diff(edges) > longest)
    more = [edges, *[np.arange(edges[i] + longest, edges[i + 1], longest) for i in long.tolist()]]
    steps = np.concatenate(more)
    for _ in range(3):
        inside = steps[steps < len(data)]
        steps = np.concatenate((inside - ((data[inside] & 0xC0) == 0x80), steps[steps >= len(data)]))
    return np.unique(steps)


def numbered(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """Id, text and the columns ``keep`` as a stored table with ``__row``, the number of each row; ``docs`` itself if it has that.

    Numbers are given in one scan and written, so that they mean the same rows wherever they are used.
    """
    if "__row" in docs.columns:
        return docs
    columns = dict.fromkeys([doc_id, text, *keep])
    return materialise(docs.select(*columns, F.monotonically_increasing_id().alias("__row")), "numbered")


def chunks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", longest: int | None = None) -> DataFrame:
    """(row, id, at, size, hi, lo): chunks with their place in the text, in bytes, and their digest.

    With ``longest`` no chunk is longer, and the ways ``before`` and ``after`` it to the nearest cuts of CUT_BITS come along.
    """

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "t", 2 << 20):
                yield _chunked(part, longest)

    source = numbered(docs, text, doc_id).select(F.col("__row").alias("row"), F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    return source.mapInArrow(run, "row bigint, id bigint, at int, size int, hi bigint, lo bigint" + ", before int, after int" * bool(longest))


def _chunked(part: pa.RecordBatch, longest: int | None = None) -> pa.RecordBatch:
    blobs = texts_of(part.column("t"))
    lengths = np.array([len(b) for b in blobs], np.int64)
    starts = np.cumsum(lengths) - lengths
    whole = b"".join(blobs)
    data = np.frombuffer(whole, np.uint8)
    if len(data):
        h = _hashes(data)

        def usable(found):
            found = found[found < len(data)]
            found = found[(data[found] & 0xC0) != 0x80]
            # cuts within the first bytes of a text would depend on the text before
            own = np.searchsorted(starts + lengths, found, side="right")
            return found[found - starts[own] >= MEMORY]

        edges = whole_edges = np.unique(np.concatenate((usable(_places(h, CUT_BITS)), starts[lengths > 0], (starts + lengths)[lengths > 0])))
        if longest:
            edges = _bounded(data, h, edges, usable, longest)
    else:
        edges = whole_edges = np.zeros(1, np.int64)
    first, last = edges[:-1], edges[1:]
    doc = np.searchsorted(starts + lengths, first, side="right")
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(whole[a:b]) for a, b in zip(first.tolist(), last.tolist())])
    sums = np.frombuffer(raw, "<i8").reshape(-1, 2)
    rows = part.column("row").to_numpy(zero_copy_only=False)[doc]
    arrays = [
        pa.array(rows, pa.int64()),
        part.column("id").take(pa.array(doc)),
        pa.array((first - starts[doc]).astype(np.int32)),
        pa.array((last - first).astype(np.int32)),
        pa.array(np.ascontiguousarray(sums[:, 0])),
        pa.array(np.ascontiguousarray(sums[:, 1])),
    ]
    names = ["row", "id", "at", "size", "hi", "lo"]
    if longest:
        before = first - np.maximum(whole_edges[np.maximum(np.searchsorted(whole_edges, first) - 1, 0)], starts[doc])
        after = np.minimum(whole_edges[np.minimum(np.searchsorted(whole_edges, last, side="right"), len(whole_edges) - 1)], (starts + lengths)[doc]) - last
        arrays, names = [*arrays, pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32))], [*names, "before", "after"]
    return pa.RecordBatch.from_arrays(arrays, names)


def _late(c: Column) -> Column:
    """Ids in order, null last."""
    return F.coalesce(c, F.lit((1 << 63) - 1))


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """Chunks of ``rows`` that occur in an earlier document, with ``first``, the earliest.

    Copies are combined before the shuffle. Hot chunks, few by the rule that defines
    them, are joined by broadcast; the others by their digest.
    """
    own = F.col("id")
    by = rows.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.min(_late(own)).alias("first"), F.max(_late(own)).alias("last"))
    by = materialise(by.where("first < last").select("hi", "lo", "n", "first"), "repeated")
    total = by.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(HOT_COPIES, total // HOT_SHARE)
    usual = rows.join(by.where(~hot).select("hi", "lo", "first"), ["hi", "lo"])
    often = rows.join(F.broadcast(by.where(hot).select("hi", "lo", "first")), ["hi", "lo"])
    return usual.unionByName(often).where(F.col("first") < _late(own))


def substring_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Runs of repeated chunks: doc_id, row, start and end in the text's UTF-8 bytes, n_chunks and first_doc_ids.

    ``row`` tells rows with the same id apart. ``first_doc_ids``: the earlier
    documents that hold the run's chunks first.
    """
    found = repeated_chunks(chunks(docs, text, doc_id))
    # runs in a document: neighbours whose end and start meet. A document's chunks are bounded by its text.
    by = Window.partitionBy("row").orderBy("at")
    breaks = F.coalesce(F.col("at") != F.lag(F.col("at") + F.col("size")).over(by), F.lit(True))
    runs = found.withColumn("new", breaks.cast("int")).withColumn("run", F.sum("new").over(by))
    runs = runs.groupBy("row", "run").agg(
        F.first("id").alias("doc_id"),
        F.min("at").cast("long").alias("start"),
        F.max(F.col("at") + F.col("size")).cast("long").alias("end"),
        F.count("*").alias("n_chunks"),
        F.sort_array(F.collect_set("first")).alias("first_doc_ids"),
    )
    return runs.where(F.col("end") - F.col("start") >= min_bytes).drop("run")


def repeated_places(rows: DataFrame) -> DataFrame:
    """Chunks of ``rows`` but the first of each digest in order of id, row and place, with ``first_id`` and ``first_row`` of that one."""
    first = F.min(F.struct(_late(F.col("id")).alias("id"), "row", "at")).alias("f")
    by = rows.groupBy("hi", "lo").agg(F.count("*").alias("n"), first).where("n > 1")
    by = by.select("hi", "lo", "n", F.col("f.id").alias("first_id"), F.col("f.row").alias("first_row"), F.col("f.at").alias("first_at"))
    by = materialise(by, "repeated")
    total = by.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(HOT_COPIES, total // HOT_SHARE)
    usual = rows.join(by.where(~hot).drop("n"), ["hi", "lo"])
    often = rows.join(F.broadcast(by.where(hot).drop("n")), ["hi", "lo"])
    return usual.unionByName(often).where((F.col("row") != F.col("first_row")) | (F.col("at") != F.col("first_at")))


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Like ``substring_duplicates``, but of every row: repeats inside a text and among rows with one id or none count too.

    ``first_doc_ids`` and ``first_rows``: the documents that hold the run's chunks first (a null
    id isn't listed); ``within``: one of these is the run's own row.
    """
    runs = _runs(repeated_places(chunks(docs, text, doc_id)))
    return runs.where(F.col("end") - F.col("start") >= min_bytes).drop("run")


def _runs(found: DataFrame, *more: Column) -> DataFrame:
    """Neighbouring chunks of ``found`` whose end and start meet, by row and run, with the aggregates ``more``."""
    by = Window.partitionBy("row").orderBy("at")
    breaks = F.coalesce(F.col("at") != F.lag(F.col("at") + F.col("size")).over(by), F.lit(True))
    runs = found.withColumn("new", breaks.cast("int")).withColumn("run", F.sum("new").over(by))
    known = F.when(F.col("first_id") != _late(F.lit(None).cast("long")), F.col("first_id"))
    return runs.groupBy("row", "run").agg(
        F.first("id").alias("doc_id"),
        F.min("at").cast("long").alias("start"),
        F.max(F.col("at") + F.col("size")).cast("long").alias("end"),
        F.count("*").alias("n_chunks"),
        F.sort_array(F.collect_set(known)).alias("first_doc_ids"),
        F.sort_array(F.collect_set("first_row")).alias("first_rows"),
        F.max(F.col("first_row") == F.col("row")).alias("within"),
        *more,
    )


def whole_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_bytes: int = MIN_BYTES) -> DataFrame:
    """``repeated_passages`` followed to their true ends: each run, whatever its length, grows as far as its bytes
    equal those around the first copy of its longest chunk; runs that then meet are one, and only then the length is tested.

    A cut of CUT_BITS inside both copies, MEMORY bytes from their start, is the same in both, so a passage ends before the next
    such cut and starts less than MEMORY bytes before the previous one: only runs that can come to ``min_bytes`` in that way are compared.
    """
    docs = numbered(docs, text, doc_id)
    found = repeated_places(chunks(docs, text, doc_id, MAX_CHUNK))
    longest = F.max(F.struct("size", (-F.col("at")).alias("from"), "first_row", "first_at")).alias("c")
    runs = _runs(found, longest, F.min_by("before", "at").alias("before"), F.max_by("after", "at").alias("after"))
    place, back, on = -F.col("c.from"), F.col("before") + MEMORY, F.col("after") + MEMORY
    runs = runs.where(F.col("end") - F.col("start") + back + on >= min_bytes)
    least, most = F.greatest(F.col("start") - back, F.lit(0)), F.col("end") + on
    runs = runs.select(
        *[c for c in runs.columns if c not in ("c", "before", "after")],
        place.cast("long").alias("at"),
        F.col("c.first_row").alias("f_row"),
        F.col("c.first_at").cast("long").alias("f_at"),
        least.cast("long").alias("least"),
        most.cast("long").alias("most"),
    )
    runs = runs.withColumn("f_least", F.greatest(F.col("f_at") - (F.col("at") - F.col("least")), F.lit(0)))
    runs = materialise(runs.withColumn("f_most", F.col("f_at") + F.col("most") - F.col("at")), "runs")
    texts = docs.select("__row", F.col(text).cast("binary").alias("__body"))

    def piece(start: str, end: str) -> Column:
        return F.substring("__body", (F.col(start) + 1).cast("int"), (F.col(end) - F.col(start)).cast("int"))

    # the first copies' bytes: once for each place, and joined back like the chunks
    keys = ["f_row", "f_least", "f_most"]
    asked = runs.groupBy(*keys).agg(F.count("*").alias("n"))
    firsts = asked.join(texts, F.col("f_row") == F.col("__row")).select(*keys, "n", piece("f_least", "f_most").alias("theirs"))
    firsts = materialise(firsts, "firsts")
    hot = F.col("n") > max(HOT_COPIES, (firsts.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE)
    usual = runs.join(firsts.where(~hot).drop("n"), keys)
    often = runs.join(F.broadcast(firsts.where(hot).drop("n")), keys)
    pairs = usual.unionByName(often).join(texts, F.col("row") == F.col("__row"))
    columns = ["row", "doc_id", "start", "end", "n_chunks", "first_doc_ids", "first_rows", "within"]
    pairs = pairs.select(*columns, "at", "f_at", "least", "f_least", piece("least", "most").alias("ours"), "theirs")
    grown = pairs.mapInArrow(_grown, schema_of(pairs, columns))
    by = Window.partitionBy("row").orderBy("start", "end")
    met = F.col("start") <= F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    grown = grown.withColumn("new", (~F.coalesce(met, F.lit(False))).cast("int"))
    grown = grown.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = grown.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.sum("n_chunks").alias("n_chunks"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("first_doc_ids", "first_rows")],
        F.max("within").alias("within"),
    )
    return merged.where(F.col("end") - F.col("start") >= min_bytes).drop("run")


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def _grown(batches):
    for batch in batches:
        start, end = [], []
        rows = [batch.column(c).to_pylist() for c in ("start", "end", "at", "f_at", "least", "f_least", "ours", "theirs")]
        for s, e, at, f_at, least, f_least, ours, theirs in zip(*rows):
            a, b = at - least, f_at - f_least
            left = a - _common(ours[:a][::-1], theirs[:b][::-1])
            right = a + _common(ours[a:], theirs[b:])
            # whole characters
            while left < a and ours[left] & 0xC0 == 0x80:
                left += 1
            while a < right < len(ours) and ours[right] & 0xC0 == 0x80:
                right -= 1
            start.append(min(s, least + left))
            end.append(max(e, least + right))
        columns = ["row", "doc_id", "start", "end", "n_chunks", "first_doc_ids", "first_rows", "within"]
        new = {"start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64())}
        yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in columns], columns)


def without_duplicates(docs: DataFrame, runs: DataFrame, text: str = "text") -> DataFrame:
    """``docs``, from ``numbered``, with the bytes of their ``runs`` cut out of the texts."""
    if "__row" not in docs.columns:
        raise ValueError("give the rows their numbers with numbered() first, and find the runs among those rows")
    cuts_of = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
    joined = docs.join(cuts_of.withColumnRenamed("row", "__r"), F.col("__row") == F.col("__r"), "left")
    body = F.col(text).cast("binary")
    start = F.concat(F.array(F.lit(0).cast("long")), F.transform("__cuts", lambda c: c["end"]))
    end = F.concat(F.transform("__cuts", lambda c: c["start"]), F.array(F.octet_length(text).cast("long")))
    pieces = F.zip_with(start, end, lambda a, b: F.substring(body, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    rest = F.when(F.col("__cuts").isNull(), F.col(text)).otherwise(F.array_join(pieces, ""))
    return joined.withColumn("__text", rest).select(*[F.col("__text").alias(c) if c == text else F.col(c) for c in docs.columns if c != "__row"])
