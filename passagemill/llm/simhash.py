"""SimHash near-duplicates over a grid of segment popcounts.

A fingerprint's 64 bits are cut into segments of two bits, and a segment is mapped to
its number of set bits. The Manhattan distance between two such vectors is at most the
Hamming distance of the fingerprints. With d + 2 blocks of segments, two vectors
within distance d agree wholly in two blocks at least: the grid has one projection
for each pair of blocks, cells are equal counts there, and a range join within the cells keeps
pairs whose whole vectors are within Manhattan distance d. The Hamming distance of
those is then checked exactly.

A cell of more than CELL_PAIRS fingerprints isn't paired out. Its fingerprints are linked
through the fingerprints one bit away: two are within two bits exactly if they are
equal to, or one bit from, a common one. That is as exact and grows with the cell and not its square (for d = 2; other d pair out).

Equal fingerprints are one class, so copies never meet as pairs. Null and empty texts
have fingerprint zero and are linked like any other. Repeated rows and ids share their
class; ids that are null come last when the smallest id is sought, and a component
of null ids only has the id null. Extra columns stay. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, materialise, schema_of, text_slices, texts_of
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SEGMENT_BITS = 2
#: Fingerprints in a cell up to which its pairs are looked at one by one.
CELL_PAIRS = 64
#: Rows of a fingerprint beyond which it counts as hot, and how many hot ones there can be.
HOT_COPIES, HOT_SHARE = 500, 100_000


def with_fingerprints(
    docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, words: int = SHINGLE_WORDS, out: str = "fp"
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the 64-bit fingerprint as a signed long."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != out]
    source = docs.select(*keep) if text in keep else docs.select(*keep, text)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text):
                prints = [fingerprint(b, words) for b in texts_of(part.column(text))]
                column = pa.array(np.array(prints, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([*kept(part, keep), column], [*keep, out])

    return source.mapInArrow(run, schema_of(docs, keep, (out, "bigint")))


_PIECE = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Bits set in over half of the shingles' XXH64, repeats counted; zero without words."""
    w = text.lower().split()
    if not w:
        return 0
    lengths = np.fromiter(map(len, w), np.int64, len(w))
    joined = b" ".join(w)
    starts = np.cumsum(lengths + 1) - lengths - 1
    if len(w) > words:
        ends = (starts + lengths)[words - 1 :].tolist()
    else:
        ends = [len(joined)]
    starts = starts.tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(ends), _PIECE):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _PIECE], ends[at : at + _PIECE])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * votes > len(ends)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum())


def segment_counts(fp: Column) -> Column:
    """The vector of set bits per segment, as one long: counts 0, 1, 2 are written 00, 01, 11."""
    ones = F.lit(0x5555555555555555)
    low, high = fp.bitwiseAND(ones), F.shiftrightunsigned(fp, 1).bitwiseAND(ones)
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two vectors of segment counts: in unary, the bits that differ."""
    return F.bit_count(a.bitwiseXOR(b))


def _projections(max_bits: int) -> list[int]:
    """For each pair of the d + 2 blocks of segments, the mask of its bits."""
    blocks = max_bits + 2
    cuts = [SEGMENT_BITS * (i * (64 // SEGMENT_BITS) // blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [_signed(masks[i] | masks[j]) for i, j in combinations(range(blocks), 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(prints: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """Edges (src, dst) that join distinct fingerprints within ``max_bits`` bits.

    ``prints`` must hold each fingerprint once. In a large cell, those that meet at a common
    value are linked to the smallest of them, so not every close pair has an edge of its own; the components are the same.
    """
    counts = segment_counts(F.col(fp))
    cells = F.array(*[F.struct(F.lit(i).alias("p"), counts.bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(_projections(max_bits))])
    rows = prints.select(F.col(fp).alias("f"), F.explode(cells).alias("c")).select("f", "c.p", "c.cell")
    sizes = rows.groupBy("p", "cell").agg(F.count("*").alias("m"), F.min("f").alias("lo"), F.max("f").alias("hi")).where("m > 1")
    sizes = materialise(sizes, "cells")
    # most shared cells hold two fingerprints, which the counting has brought together
    twos = sizes.where("m = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    some = sizes.where("m > 2").select("p", "cell", "m")
    members = rows.join(some, ["p", "cell"])
    large = F.col("m") > (cell_pairs if max_bits == 2 else 1 << 62)
    small = members.where(~large)
    paired = small.alias("x").join(small.alias("y"), ["p", "cell"]).where("x.f < y.f").select(F.col("x.f").alias("a"), F.col("y.f").alias("b"))
    near = manhattan(segment_counts(F.col("a")), segment_counts(F.col("b"))) <= max_bits
    exact = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    direct = twos.unionByName(paired).where(near).where(exact).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    if max_bits != 2:
        return direct.distinct()
    flips = F.array(F.lit(0), *[F.lit(_signed(1 << i)) for i in range(64)])
    wide = members.where(large).select("f").distinct()
    spokes = wide.select("f", F.explode(flips).alias("bit")).select("f", F.col("f").bitwiseXOR(F.col("bit")).alias("hub"))
    met = spokes.groupBy("hub").agg(F.min("f").alias("first"), F.count("*").alias("n")).where("n > 1").select("hub", "first")
    via = spokes.join(met, "hub").where(F.col("f") != F.col("first")).select(F.col("first").alias("src"), F.col("f").alias("dst"))
    return direct.unionByName(via).distinct()


def classes(
    fingerprints: DataFrame, member: Column, fp: str = "fp", max_bits: int = MAX_BITS, cell_pairs: int = CELL_PAIRS
) -> DataFrame:
    """(fp, best, n): the smallest ``member`` of each fingerprint's component, and the rows of the fingerprint.

    ``fingerprints`` must be a written table, since it is read more than once.
    """
    prints = materialise(fingerprints.groupBy(fp).agg(F.min(member).alias("best"), F.count("*").alias("n")), "prints")
    edges = materialise(links(prints.select(fp), fp, max_bits, cell_pairs), "links")
    labels = components(edges)
    joined = prints.join(labels.select(F.col("node").alias(fp), "component"), fp, "left")
    joined = joined.withColumn("component", F.coalesce("component", fp))
    best = joined.groupBy("component").agg(F.min("best").alias("best"))
    linked = labels.join(best, "component").select(F.col("node").alias("__fp"), F.col("best").alias("__best"))
    return prints.join(linked, F.col(fp) == F.col("__fp"), "left").select(fp, F.coalesce("__best", "best").alias("best"), "n")


def join_classes(rows: DataFrame, found: DataFrame, fp: str = "fp") -> DataFrame:
    """Each row with its class. Fingerprints of very many rows, few by the rule that
    defines them (at most HOT_SHARE), are joined by broadcast, the others by fingerprint."""
    found = materialise(found, "classes")
    total = found.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(HOT_COPIES, total // HOT_SHARE)
    usual = rows.join(found.where(~hot).drop("n"), fp)
    return usual.unionByName(rows.join(F.broadcast(found.where(hot).drop("n")), fp))


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    rows = materialise(with_fingerprints(docs, text, [doc_id], words), "fingerprints")
    found = classes(rows, F.struct(F.col(doc_id).isNull().alias("missing"), F.col(doc_id).alias("id")), max_bits=max_bits)
    found = join_classes(rows, found.select("fp", F.col("best.id").alias("component_id"), "n"))
    return found.select(F.col(doc_id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one row of each component: the smallest id (null last), then the smallest text hash.

    Rows with the same id and text are one document; one of them stays.
    """
    hashed = F.xxhash64(F.col(text))
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"), hashed.alias("h"))
    rows = materialise(with_fingerprints(source, "t", ["id", "h"], words), "fingerprints")
    member = F.struct(F.col("id").isNull().alias("missing"), F.col("id").alias("id"), F.col("h").alias("h"))
    best = classes(rows, member, max_bits=max_bits)
    stay = best.select(F.col("best.id").alias("__id"), F.col("best.h").alias("__h")).distinct()
    often = rows.groupBy("id", "h").agg(F.count("*").alias("__n"))
    keys = F.col("__id").eqNullSafe(F.col("id")) & (F.col("__h") == F.col("h"))
    stay = materialise(stay.join(often, keys).select("__id", "__h", "__n"), "kept")
    marked = docs.withColumn("__hash", hashed)
    found = marked.join(stay, F.col("__id").eqNullSafe(F.col(doc_id)) & (F.col("__h") == F.col("__hash")))
    found = found.select(*docs.columns, "__n", "__hash")
    once = found.where("__n = 1").select(*docs.columns)
    return once.unionByName(found.where("__n > 1").dropDuplicates([doc_id, "__hash"]).select(*docs.columns))
