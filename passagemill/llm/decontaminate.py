"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are windows of consecutive benchmark words, written as `` w1 w2 ... `` with
single spaces around and between; documents are rewritten the same way. A table over
hashed blocks says how far the search may jump, a bucket of patterns by suffix block
says which could end where the jump is zero, and a comparison of the bytes confirms.
Many places of the text are searched at once, one step of each at a time.

Words are maximal runs of ASCII letters (lower-cased), digits and all characters
beyond ASCII. Null and empty texts have no words and are clean. Repeated benchmark
items share patterns; an item without an id marks words but is in no list of items.
Repeated documents are searched one by one. An empty benchmark leaves all clean.
Other columns pass through; a result column takes the place of one of its name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, kept, materialise, schema_of, text_slices, texts_of

#: Words, after A-Z have been lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
#: Patterns are searched in blocks of about so many bytes; one block is shipped at a time.
BLOCK_BYTES = 16 << 20

_KEEP = bytes(
    (c | 32 if 65 <= c <= 90 else c) if (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) else 32 for c in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Patterns of similar length are searched together: lower bounds of their bytes.
_CLASSES = (3, 16, 32)
_LANE_BYTES = 512


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", words: int = WINDOW_WORDS) -> DataFrame:
    """Distinct windows: pattern, its number of words and the ids (as strings) of its items."""
    w = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(f"({WORD})"), F.lit(1))
    rows = benchmark.select(F.col(item).cast("string").alias("item"), w.alias("w")).where(F.size("w") > 0)
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - words + 1, F.lit(1)))))
    piece = F.slice("w", F.col("at"), F.lit(words))
    rows = rows.select("item", F.concat(F.lit(" "), F.array_join(piece, " "), F.lit(" ")).alias("pattern"), F.size(piece).alias("n"))
    return rows.groupBy("pattern", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    words: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with n_words, n_hit, items (array of ids as strings), hit_spans (word ranges) and contaminated.

    A benchmark larger than ``block_bytes`` is searched in several passes over the
    rows, each with one bounded block of patterns; the passes share one stage.
    ``keep``: the columns to pass through, all by default.
    """
    found = materialise(windows(benchmark, item, item_text, words), "windows")
    volume = found.agg(F.sum(F.octet_length("pattern") + 16 * (1 + F.size("items")))).first()[0] or 0
    blocks = 1 + int(volume // block_bytes)
    new = ("n_words", "n_hit", "items", "hit_spans", "contaminated")
    results = (
        ("n_words", "bigint"),
        ("n_hit", "bigint"),
        ("items", "array<string>"),
        ("hit_spans", "array<struct<start:bigint,end:bigint>>"),
    )
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    passed = keep if text in keep else [*keep, text]
    out = docs.select(*passed)
    number = F.pmod(F.xxhash64("pattern"), F.lit(blocks))
    for b in range(blocks):
        rows = [(r[0].encode(), r[1], r[2]) for r in found.where(number == b).sort("pattern").collect()]
        shipped = docs.sparkSession.sparkContext.broadcast(tables(rows))
        columns = keep if b == blocks - 1 else passed
        out = out.mapInArrow(_searcher(shipped, text, columns, b > 0), schema_of(docs, columns, *results))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def tables(patterns: Sequence[tuple[bytes, int, list[str]]]) -> list[tuple]:
    """The search tables of each class of pattern lengths, as plain arrays."""
    classes = defaultdict(list)
    for p in patterns:
        classes[max(c for c in _CLASSES if c <= len(p[0]))].append(p)
    out = []
    for group in classes.values():
        m = min(64, min(len(p) for p, _, _ in group))
        block = min(8, m)
        bits = min(22, max(12, int(np.ceil(np.log2(len(group) * 64)))))
        raw = np.frombuffer(b"".join(p[:m] for p, _, _ in group), np.uint8).reshape(-1, m)
        shift = np.full(1 << bits, m - block + 1, np.int64)
        for j in range(m - block + 1):
            h = _hash(_block(raw, j, block), bits)
            np.minimum.at(shift, h, m - block - j)
        suffix = _hash(_block(raw, m - block, block), bits)
        order = np.argsort(suffix, kind="stable")
        first = np.searchsorted(suffix[order], np.arange((1 << bits) + 1))
        prefix = _block(raw, 0, block)
        out.append((m, block, bits, shift, order, first, prefix, [p for p, _, _ in group], [n for _, n, _ in group], [i for _, _, i in group]))
    return out


def _block(raw: np.ndarray, j: int, size: int) -> np.ndarray:
    value = np.zeros(len(raw), np.uint64)
    for k in range(size):
        value |= raw[:, j + k].astype(np.uint64) << np.uint64(8 * k)
    return value


def _hash(value: np.ndarray, bits: int) -> np.ndarray:
    return ((value * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def search(data: bytes, table: tuple) -> list[tuple[int, int]]:
    """(place, pattern number) of each occurrence in ``data``."""
    m, block, bits, shift, order, first, prefix, patterns, _, _ = table
    n = len(data) - m + 1
    if n <= 0:
        return []
    padded = data + bytes(8)
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    mask = np.uint64((1 << (8 * block)) - 1) if block < 8 else np.uint64(0xFFFFFFFFFFFFFFFF)
    place = np.arange(0, n, _LANE_BYTES, dtype=np.int64)
    end = np.minimum(place + _LANE_BYTES, n)
    places, buckets = [], []
    while len(place):
        h = _hash(words[place + (m - block)] & mask, bits)
        jump = shift[h]
        stop = jump == 0
        if stop.any():
            places.append(place[stop])
            buckets.append(h[stop])
        place = place + np.maximum(jump, 1)
        alive = place < end
        if not alive.all():
            place, end = place[alive], end[alive]
    if not places:
        return []
    place, bucket = np.concatenate(places), np.concatenate(buckets)
    many = first[bucket + 1] - first[bucket]
    at = np.repeat(place, many)
    offset = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    which = order[np.repeat(first[bucket], many) + offset]
    likely = (words[at] & mask) == prefix[which]
    return [(p, w) for p, w in zip(at[likely].tolist(), which[likely].tolist()) if data.startswith(patterns[w], p)]


def _searcher(shipped, text, keep, again):
    def run(batches):
        search_tables = shipped.value
        for batch in batches:
            for part in text_slices(batch, text):
                yield _one(part, search_tables, text, keep, again)

    return run


def _one(part: pa.RecordBatch, search_tables, text, keep, again) -> pa.RecordBatch:
    blobs = [b.translate(_KEEP) for b in texts_of(part.column(text))]
    data = np.frombuffer(b" " + b" \0 ".join(blobs) + b" \0", np.uint8)
    space = data == 32
    data = data[~(space & np.concatenate(([False], space[:-1])))]
    ends = np.flatnonzero(data == 0)
    gap = (data == 32) | (data == 0)
    starts = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    low = np.searchsorted(starts, np.concatenate(([0], ends[:-1])))
    high = np.searchsorted(starts, ends)
    change = np.zeros(len(starts) + 1, np.int64)
    items: list[set] = [set() for _ in blobs]
    if again:
        for i, (before, spans) in enumerate(zip(part.column("items").to_pylist(), part.column("hit_spans").to_pylist())):
            items[i].update(before)
            for s in spans:
                change[low[i] + s["start"]] += 1
                change[low[i] + s["end"]] -= 1
    raw = data.tobytes()
    for table in search_tables:
        hits = search(raw, table)
        if hits:
            at = np.array([p for p, _ in hits])
            word = np.searchsorted(starts, at + 1)
            np.add.at(change, word, 1)
            np.add.at(change, word + np.array([table[8][w] for _, w in hits]), -1)
            for doc, (_, w) in zip(np.searchsorted(ends, at).tolist(), hits):
                items[doc].update(table[9][w])
    hit = np.cumsum(change) > 0
    total = np.concatenate(([0], np.cumsum(hit)))
    n_hit = total[high] - total[low]
    spans: list[list] = [[] for _ in blobs]
    for i in np.flatnonzero(n_hit):
        own = np.concatenate(([0], hit[low[i] : high[i]].view(np.int8), [0]))
        edge = np.flatnonzero(np.diff(own))
        spans[i] = [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    arrays = kept(part, keep) + [
        pa.array(high - low, pa.int64()),
        pa.array(n_hit, pa.int64()),
        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        pa.array(spans, kind),
    ]
    return pa.RecordBatch.from_arrays(arrays, [*keep, "n_words", "n_hit", "items", "hit_spans"])
