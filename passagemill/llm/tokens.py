"""Token ids as a compressed binary corpus: static range asymmetric numeral system (rANS).

Documents are tokenised by a public tokenizer and put in ascending order of their id.
Token frequencies over the whole corpus are scaled to one shared table. Frames of whole documents
hold independent blocks of token ids. In a block, ids are dealt over interleaved
coders in turn, whose 64-bit states put out 32-bit words into one common stream. Checkpoints in a block
hold the states and the place in the stream, so that its parts decode in parallel; a
checksum (crc32) of each block's ids is tested after decoding.

On disk: ``<path>/frequencies`` (id, frequency; they add up to 2^bits) and
``<path>/frames``, one row a frame: part and frame (in order), start (ids before it),
doc_ids, n_tokens of each document, blocks (tokens, words, crc32, checkpoints' offsets, states) and the stream
as binary, little-endian. Payloads are compressed already, so the files aren't.

Null texts are empty: they are their end id only. Null ids come first; equal ids keep
the order of the input. Repeated rows are rows of their own. An empty table
gives no frames. Extra columns aren't stored. Ids must be whole numbers, or texts of such, and are kept as long integers.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Remembered, drop_path, materialise, running_start, scratch_path, text_slices, texts_of

END_ID = 2
#: Frequencies add up to 2 to this power.
BITS = 18
#: Interleaved coders, steps between checkpoints, checkpoints in a block, tokens after which a frame ends.
LANES, STEPS, PARTS = 32, 512, 4
BLOCK_TOKENS = LANES * STEPS * PARTS
FRAME_TOKENS = 16 * BLOCK_TOKENS
_LOW = np.uint64(1 << 32)
_LOW32 = np.uint64(0xFFFFFFFF)
#: Different words that a task remembers with their ids.
CACHE_WORDS = 200_000
#: Letters that normalisation leaves alone but for their case, with one mark behind: one or two pieces before merging.
_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write each byte: as itself where that is visible, else by the next letters after 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


_LETTERS = _byte_letters()


# ---- tokens ---------------------------------------------------------------------------


class Encoder:
    """Ids of texts by a tokenizers file, remembered by word.

    White space never joins pieces and is dropped by this kind of vocabulary, so a
    text's ids are those of its words one after another. Normalisation and splitting leave plain
    words as they are (in lower case), so those go straight to the library's model.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.kind = np.dtype(id_type(self.tokenizer))
        self.words = Remembered(self._word, CACHE_WORDS)
        self.stems = Remembered(self._stem, CACHE_WORDS)
        self.marks = {m: self._whole(m.decode()) for m in (b".", b",")}
        self.tokenize = self.tokenizer.model.tokenize
        self.each = [i.to_bytes(self.kind.itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.kind).tobytes()

    def _word(self, w: bytes) -> bytes:
        if w.isalpha():  # of ASCII letters
            return self.stems[w.lower()]
        stem, mark = w[:-1], w[-1:]
        if mark in self.marks and stem.isalpha():
            return self.stems[stem.lower()] + self.marks[mark]
        word = w.decode()
        m = _SIMPLE.fullmatch(word)
        if not m:
            return self._whole(word)
        stem, mark = m.groups()
        ids = self.stems[stem.lower().encode()]
        return ids + self.marks[mark.encode()] if mark else ids

    def _stem(self, stem: bytes) -> bytes:
        each = self.each
        spelled = stem.decode() if stem.isascii() else "".join([_LETTERS[b] for b in stem])
        return b"".join([each[t.id] for t in self.tokenize(spelled)])

    def encode(self, texts: list[bytes], end: int) -> list[bytes]:
        """Ids of each text and ``end``, as little-endian integers."""
        self.words.turn()
        self.stems.turn()
        ids_of, tail = self.words.__getitem__, end.to_bytes(self.kind.itemsize, "little")
        return [b"".join(map(ids_of, t.split())) + tail for t in texts]


def id_type(tokenizer) -> str:
    return "<u4" if tokenizer.get_vocab_size() > 1 << 16 else "<u2"



def tokenised(docs: DataFrame, tokenizer_file: str, text: str, doc_id: str, end: int) -> tuple[DataFrame, str, str]:
    """Written table (part, doc_id, ids) in order by parts and rows, and the integer type of its ids; its path."""
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    spark = docs.sparkSession
    # a worker process keeps what it was sent, so the encoder beside it, with the words it has learned, serves all its tasks
    shipped = spark.sparkContext.broadcast({"content": content})
    from tokenizers import Tokenizer

    kind = id_type(Tokenizer.from_str(content))

    def run(batches):
        held = shipped.value
        for batch in batches:
            encoder = held.get("encoder") or held.setdefault("encoder", Encoder(held["content"]))
            for part in text_slices(batch, "t", 2 << 20):
                ids = encoder.encode(texts_of(part.column("t")), end)
                arrays = [part.column("doc_id"), part.column("place"), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "place", "ids"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("place"), F.col(text).alias("t"))
    rows = source.mapInArrow(run, "doc_id bigint, place bigint, ids binary")
    unsorted = scratch_path(spark, "ids")
    rows.write.option("compression", "zstd").parquet(unsorted)
    return spark.read.schema(rows.schema).parquet(unsorted), unsorted, kind


# ---- rANS -----------------------------------------------------------------------------


def scaled(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies in proportion to ``counts`` that add up to 2^bits; at least 1 where there is a count."""
    total, whole = int(counts.sum()), 1 << bits
    if not total:
        return np.zeros(len(counts), np.int64)
    if (counts > 0).sum() > whole:
        raise ValueError("more different ids than the table has places")
    out = np.where(counts > 0, np.maximum(1, counts * whole // total), 0).astype(np.int64)
    gap = whole - int(out.sum())
    order = np.lexsort((np.arange(len(counts)), -counts))
    if gap > 0:
        out[order[0]] += gap
    for i in order:
        if gap >= 0:
            break
        cut = min(int(out[i]) // 2, -gap)
        out[i] -= cut
        gap += cut
    while gap < 0:  # very even counts
        i = int(out.argmax())
        out[i] -= 1
        gap += 1
    return out


def encode(ids: np.ndarray, frequency: np.ndarray, bits: int = BITS) -> list[dict]:
    """Blocks of ``ids``, all coded side by side: tokens, crc32, words (bytes), offsets and states of the checkpoints."""
    n_blocks = -(-len(ids) // BLOCK_TOKENS)
    steps = STEPS * PARTS if n_blocks > 1 else max(1, -(-len(ids) // LANES))
    fill = int(frequency.argmax())
    padded = np.full(n_blocks * steps * LANES, fill, np.int64)
    padded[: len(ids)] = ids
    grid = padded.reshape(n_blocks, steps, LANES)
    start = np.cumsum(frequency) - frequency
    freq, begin = frequency.astype(np.uint64), start.astype(np.uint64)
    state = np.full((n_blocks, LANES), _LOW, np.uint64)
    put = np.zeros((steps, n_blocks, LANES), bool)
    words = np.zeros((steps, n_blocks, LANES), np.uint32)
    states = {}
    shift, up = np.uint64(bits), np.uint64(64 - bits)
    for t in range(steps - 1, -1, -1):
        s = grid[:, t]
        f = freq[s]
        full = state >= (f << up)
        put[t] = full
        words[t] = (state & _LOW32).astype(np.uint32)
        state = np.where(full, state >> np.uint64(32), state)
        q = state // f
        state = (q << shift) + (state - q * f) + begin[s]
        if t % STEPS == 0:
            states[t] = state
    out = []
    used = put.sum(2, dtype=np.int64)
    for b in range(n_blocks):
        own = ids[b * BLOCK_TOKENS : (b + 1) * BLOCK_TOKENS]
        at = sorted(states)
        before = np.concatenate(([0], np.cumsum(used[:, b])))
        out.append(
            {
                "tokens": len(own),
                "steps": steps,
                "crc32": zlib.crc32(own.astype("<u4").tobytes()),
                "words": words[:, b][put[:, b]].astype("<u4").tobytes(),
                "offsets": before[at].astype("<u4").tobytes(),
                "states": np.stack([states[t][b] for t in at]).astype("<u8").tobytes(),
            }
        )
    return out


def decode(blocks: list[dict], frequency: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Ids of the blocks; parts between checkpoints are decoded side by side."""
    start = np.cumsum(frequency) - frequency
    symbol = np.repeat(np.arange(len(frequency)), frequency)
    # for each place of the table: its frequency and its distance from the symbol's start
    freq = frequency[symbol].astype(np.uint64)
    inside = (np.arange(len(symbol)) - start[symbol]).astype(np.uint64)
    base, streams, jobs = 0, [], []
    for i, b in enumerate(blocks):
        offsets = np.frombuffer(b["offsets"], "<u4").astype(np.int64)
        states = np.frombuffer(b["states"], "<u8").reshape(len(offsets), LANES)
        for k, o in enumerate(offsets.tolist()):
            jobs.append((min(STEPS, b["steps"] - k * STEPS), i, k, base + o, states[k]))
        streams.append(b["words"])
        base += len(b["words"]) // 4
    stream = np.frombuffer(b"".join(streams) + bytes(4 * LANES), "<u4")
    out = [np.zeros((b["steps"], LANES), np.int32) for b in blocks]
    for length in sorted({j[0] for j in jobs}):
        group = [j for j in jobs if j[0] == length]
        state = np.stack([j[4] for j in group]).astype(np.uint64)
        at = np.array([j[3] for j in group])
        made = np.empty((length, len(group), LANES), np.int32)
        mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
        for t in range(length):
            slot = (state & mask).astype(np.int64)
            made[t] = symbol[slot]
            state = freq[slot] * (state >> shift) + inside[slot]
            need = state < _LOW
            rank = np.cumsum(need, axis=1)
            word = stream[np.minimum(at[:, None] + rank - 1, len(stream) - 1)]
            state = np.where(need, (state << np.uint64(32)) | word, state)
            at += rank[:, -1]
        for g, (_, i, k, _, _) in enumerate(group):
            out[i][k * STEPS : k * STEPS + length] = made[:, g]
    whole = [o.reshape(-1)[: b["tokens"]] for o, b in zip(out, blocks)]
    for ids, b in zip(whole, blocks):
        if zlib.crc32(ids.astype("<u4").tobytes()) != b["crc32"]:
            raise ValueError("a block of token ids is damaged: its checksum doesn't match")
    return np.concatenate(whole) if whole else np.zeros(0, np.int32)


# ---- files ----------------------------------------------------------------------------

_BLOCK = "struct<tokens:bigint,steps:bigint,crc32:bigint,words:bigint,offsets:binary,states:binary>"
FRAME = f"part int, frame bigint, doc_ids array<bigint>, n_tokens array<bigint>, tokens bigint, blocks array<{_BLOCK}>, stream binary"
_BLOCK_TYPE = pa.struct(
    [("tokens", pa.int64()), ("steps", pa.int64()), ("crc32", pa.int64()), ("words", pa.int64()), ("offsets", pa.binary()), ("states", pa.binary())]
)


def _frame(part: int, number: int, doc_ids: list, ids: list[bytes], kind: str, frequency: np.ndarray) -> pa.RecordBatch:
    all_ids = np.frombuffer(b"".join(ids), kind).astype(np.int64)
    blocks = encode(all_ids, frequency)
    each = np.dtype(kind).itemsize
    rows = [{**b, "words": len(b["words"]) // 4} for b in blocks]
    arrays = [
        pa.array([part], pa.int32()),
        pa.array([number], pa.int64()),
        pa.array([doc_ids], pa.list_(pa.int64())),
        pa.array([[len(x) // each for x in ids]], pa.list_(pa.int64())),
        pa.array([len(all_ids)], pa.int64()),
        pa.array([rows], pa.list_(_BLOCK_TYPE)),
        pa.array([b"".join(b["words"] for b in blocks)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["part", "frame", "doc_ids", "n_tokens", "tokens", "blocks", "stream"])


def write_corpus(
    docs: DataFrame, path: str, tokenizer_file: str, text: str = "text", doc_id: str = "doc_id", end: int = END_ID, frame_tokens: int = FRAME_TOKENS
) -> None:
    """Tokenise ``docs`` and write the corpus to ``path`` in ascending order of ``doc_id``."""
    spark = docs.sparkSession
    rows, rows_path, kind = tokenised(docs, tokenizer_file, text, doc_id, end)

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in text_slices(batch, "ids"):
                own = np.bincount(np.frombuffer(b"".join(part.column("ids").to_pylist()), kind))
                if len(own) > len(total):
                    total = np.concatenate((total, np.zeros(len(own) - len(total), np.int64)))
                total[: len(own)] += own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    found = rows.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([end, *[r.id for r in found]]) + 1, np.int64)  # one row an id of the vocabulary
    for r in found:
        counts[r.id] = r.n
    frequency = scaled(counts)
    table = [(i, int(f)) for i, f in enumerate(frequency.tolist()) if f]
    spark.createDataFrame(table, "id bigint, frequency bigint").coalesce(1).write.parquet(f"{path}/frequencies")
    shipped = spark.sparkContext.broadcast(frequency)

    def frames(batches):
        doc_ids, ids, size, part, number = [], [], 0, None, 0
        for batch in batches:
            for p, d, x in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                part = p
                doc_ids.append(d)
                ids.append(x)
                size += len(x) // np.dtype(kind).itemsize
                if size >= frame_tokens:
                    yield _frame(part, number, doc_ids, ids, kind, shipped.value)
                    doc_ids, ids, size, number = [], [], 0, number + 1
        if ids:
            yield _frame(part, number, doc_ids, ids, kind, shipped.value)

    ranged = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("place")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "place")
    ranged = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "ids")
    ranged.mapInArrow(frames, FRAME).write.option("compression", "uncompressed").parquet(f"{path}/frames")
    drop_path(spark, rows_path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files: ids as little-endian unsigned 32-bit integers."""
    frames = spark.read.parquet(f"{path}/frames")
    sizes = materialise(frames.select("part", "frame", "tokens"), "frame-sizes")
    starts = running_start(sizes, "part", ["frame"], "tokens", "start").select(F.col("part").alias("p"), F.col("frame").alias("f"), "start")
    table = np.zeros((0, 2), np.int64)
    found = spark.read.parquet(f"{path}/frequencies").collect()
    table = np.array([(r.id, r.frequency) for r in found], np.int64).reshape(-1, 2)
    frequency = np.zeros(int(table[:, 0].max()) + 1 if len(table) else 0, np.int64)
    frequency[table[:, 0]] = table[:, 1]
    shipped = spark.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                at, blocks = 0, []
                for b in r["blocks"]:
                    blocks.append({**b, "words": r["stream"][at : at + 4 * b["words"]]})
                    at += 4 * b["words"]
                ids = decode(blocks, shipped.value)
                sizes = np.array(r["n_tokens"], np.int64)
                ends = np.cumsum(sizes)
                raw = memoryview(ids.astype("<u4").tobytes())
                n = max(1, len(sizes))
                for a in range(0, n, 2000):
                    b = min(n, a + 2000)
                    arrays = [
                        pa.array([r["part"]] * (b - a), pa.int32()),
                        pa.array([r["frame"]] * (b - a), pa.int64()),
                        pa.array(r["doc_ids"][a:b], pa.int64()),
                        pa.array((ends - sizes)[a:b]),
                        pa.array(sizes[a:b]),
                        pa.array([raw[4 * (y - x) : 4 * y] for x, y in zip(sizes[a:b].tolist(), ends[a:b].tolist())], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["part", "frame", "doc_id", "inner", "n_tokens", "ids"])

    rows = frames.select("part", "frame", "doc_ids", "n_tokens", "blocks", "stream")
    rows = rows.mapInArrow(run, "part int, frame bigint, doc_id bigint, inner bigint, n_tokens bigint, ids binary")
    joined = rows.join(F.broadcast(starts) if _few(sizes) else starts, (F.col("part") == F.col("p")) & (F.col("frame") == F.col("f")))
    return joined.select("doc_id", (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids")


#: Frames up to which their starts (24 bytes each) are shipped to every task.
SHIPPED_FRAMES = 1_000_000


def _few(sizes: DataFrame) -> bool:
    return sizes.count() <= SHIPPED_FRAMES
