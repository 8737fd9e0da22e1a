"""Exact and probed top-k cosine search for a table of queries.

Two physical strategies, chosen by the checked size of the query matrix:

* few queries (and few candidates: tasks times queries times k): the matrix is shipped to every task; each task streams its part of
  the collection, keeps a running top-k per query and emits only that. The
  collection is neither shuffled nor joined.
* many queries: both sides are dealt over a grid of blocks that has no more columns and rows than the
  memory of a task and the number of cores ask for, so that a vector travels a few times however many
  queries there are, and a query once to each block that holds one of its cells. A task holds a block's vectors
  while its queries stream past. Small cells share blocks, hot ones are split over several.

Both end in one ``row_number`` over the per-task winners. Score is the cosine in
double precision; a zero vector has none and is never ranked. Ties go to the
smaller key. The matrix product only selects: its last bit depends on where a row
lies in its batch, so all rows within MARGIN of the k-th place are scored again, each
by one sum over its own products, and ranked by that. Both strategies, and any
partitioning, therefore give the same ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SearchConfig

SCORES_AT_ONCE = 4_000_000
#: Cosines from a matrix product and from a sum of products differ by less.
MARGIN = 1e-9
#: Unit vectors in single precision: a product of ``dim`` components is off by less than half of this times dim + 4.
MARGIN_32 = 2.0**-22
#: Queries up to which the matrix is shipped: every task hands in k rows for each of them.
_SCAN_QUERIES = 5_000
#: Memory of a block's vectors in double precision, queries and vectors that a matrix product takes at once.
BLOCK_BYTES = 64 * 1024 * 1024
_QUERIES_AT_ONCE, _VECTORS_AT_ONCE = 2_000, 2_000
#: A grid has about so many blocks a core if memory doesn't ask for more, and no turn of fewer queries only for that.
_BLOCKS_PER_CORE = 4
_LEAST_TURN = 1_000
_EXACT_VALUES = 1_000_000
#: Components of vectors that a task with shipped queries works on at a time.
_SCAN_VALUES = 1_000_000
_EMIT_ROWS = 10_000
_MOST_PARTITIONS = 50_000
_SMALL_HITS = 200_000
_LARGE_K = 100
_MERGE_PARTS = 64
_LISTED_MODELS = 1000


def matrix_of(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(float64 matrix of the usable rows, their positions).

    Null vectors are left out; vectors of different length are an error.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    usable = np.flatnonzero(np.asarray(vectors.is_valid()))
    if len(usable) < len(vectors):
        vectors = vectors.take(pa.array(usable))
    if not len(usable):
        return np.zeros((0, 0)), usable
    lengths = np.diff(np.asarray(vectors.offsets))
    if (lengths != lengths[0]).any():
        raise ValueError(f"vectors of different dimension: {sorted(set(lengths.tolist()))}")
    flat = vectors.flatten()
    return np.asarray(flat, dtype=np.float64).reshape(len(usable), int(lengths[0])), usable


@dataclass
class QueryBlock:
    """Queries held in memory: names, vectors, squared norms, cells to look into."""

    names: pa.Array
    matrix: np.ndarray
    squares: np.ndarray
    cells: np.ndarray | None = None  # (queries, nprobe), or None for all cells

    @staticmethod
    def of(names: pa.Array, vectors: pa.Array, cells: np.ndarray | None = None) -> QueryBlock:
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        matrix, usable = matrix_of(vectors)
        squares = (matrix * matrix).sum(axis=1) if matrix.size else np.zeros(0)
        good = np.flatnonzero(squares > 0)
        return QueryBlock(names.take(pa.array(usable[good])), matrix[good], squares[good], cells)


def prepared(batch: pa.RecordBatch | pa.Table, vector: str, keys: list[str], cell: str | None = None) -> tuple:
    """(keys, matrix, squared norms, cells) of the rows that can be hits."""
    matrix, usable = matrix_of(batch.column(vector))
    squares = (matrix * matrix).sum(axis=1)
    good = np.flatnonzero(squares > 0)
    rows = pa.table({c: batch.column(c) for c in keys}).take(pa.array(usable[good]))
    cells = None if cell is None else np.asarray(batch.column(cell))[usable[good]]
    return rows, matrix[good], squares[good], cells


class BestK:
    """Running top-k per query over batches of (key columns, vectors)."""

    def __init__(self, queries: QueryBlock, k: int, keys: list[str]):
        self.q, self.k, self.keys = queries, k, keys
        self.best: pa.Table | None = None
        self.floor = np.full(len(queries.squares), -np.inf)

    def add(self, batch: pa.RecordBatch | pa.Table, vector: str, cell: str | None = None) -> None:
        step = max(1, _SCAN_VALUES // max(1, self.q.matrix.shape[1]))
        for at in range(0, batch.num_rows, step):
            self.add_prepared(prepared(batch.slice(at, step), vector, self.keys, cell))

    def add_prepared(self, vectors: tuple) -> None:
        rows, matrix, squares, cells = vectors
        if not len(squares) or not len(self.floor):
            return
        if matrix.shape[1] != self.q.matrix.shape[1]:
            raise ValueError(f"query dimension {self.q.matrix.shape[1]}, vector dimension {matrix.shape[1]}")
        if cells is None or self.q.cells is None:
            self._add_rows(np.arange(len(self.floor)), rows, matrix, squares)
            return
        for c in np.unique(cells):
            asking = np.flatnonzero((self.q.cells == c).any(axis=1))
            if len(asking):
                here = np.flatnonzero(cells == c)
                self._add_rows(asking, rows.take(pa.array(here)), matrix[here], squares[here])

    def _add_rows(self, asking: np.ndarray, rows: pa.Table, matrix: np.ndarray, squares: np.ndarray) -> None:
        step = max(1, SCORES_AT_ONCE // max(1, len(asking)))
        q, qs = self.q.matrix[asking], self.q.squares[asking]
        for at in range(0, len(squares), step):
            dots = q @ matrix[at : at + step].T
            scores = dots / np.sqrt(qs[:, None] * squares[None, at : at + step])
            floor = self.floor[asking]
            if scores.shape[1] > self.k:
                # Only a row at or above the k-th best of this batch can win;
                # ties at that place stay in and are settled by key below.
                kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
                floor = np.maximum(floor, kth)
            qi, ri = np.nonzero(scores >= floor[:, None] - MARGIN)
            if len(qi):
                ri = ri + at
                self._merge(asking[qi], _cosines(q, qs, matrix, squares, qi, ri), rows.take(pa.array(ri)))

    def _merge(self, qi: np.ndarray, scores: np.ndarray, rows: pa.Table) -> None:
        new = rows.append_column("__q", pa.array(qi)).append_column("__s", pa.array(scores))
        both = new if self.best is None else pa.concat_tables([self.best, new])
        order = pc.sort_indices(
            both, sort_keys=[("__q", "ascending"), ("__s", "descending"), *[(c, "ascending") for c in self.keys]]
        )
        both = both.take(order)
        q = np.asarray(both.column("__q"))
        first = np.searchsorted(q, q, side="left")
        place = np.arange(len(q)) - first
        keep = np.flatnonzero(place < self.k)
        self.best = both.take(pa.array(keep)).combine_chunks()
        full = keep[place[keep] == self.k - 1]
        self.floor[q[full]] = np.asarray(both.column("__s"))[full]

    def batches(self, query_name: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.best is None or not self.best.num_rows:
            return
        names = self.q.names.take(self.best.column("__q").combine_chunks())
        out = pa.table(
            {query_name: names, **{c: self.best.column(c) for c in self.keys}, "score": self.best.column("__s")}
        )
        out = out.select(schema.names).cast(schema)
        yield from out.to_batches(max_chunksize=_EMIT_ROWS)


def _cosines(q, qs, matrix, squares, qi, ri) -> np.ndarray:
    """Cosines of the given pairs, each summed in the same order wherever its rows lie."""
    step = max(1, _EXACT_VALUES // max(1, matrix.shape[1]))
    dots = [(q[qi[at : at + step]] * matrix[ri[at : at + step]]).sum(axis=1) for at in range(0, len(qi), step)]
    return np.concatenate(dots) / np.sqrt(qs[qi] * squares[ri])


def _hit_schema(queries: DataFrame, query_id: str, collection: DataFrame, keys: list[str]) -> T.StructType:
    fields = [T.StructField(query_id, queries.schema[query_id].dataType)]
    fields += [T.StructField(c, collection.schema[c].dataType) for c in keys]
    return T.StructType([*fields, T.StructField("score", T.DoubleType())])


def rank(candidates: DataFrame, query_id: str, keys: list[str], k: int) -> DataFrame:
    """Best ``k`` candidates per query with their rank ``rk`` (1 is best).

    Every task hands in up to ``k`` candidates per query. For a large ``k`` that is
    too much for the one task a query ends in, so they are thinned out in parallel
    parts of each query first.
    """
    best_first = [F.col("score").desc(), *keys]
    if k > _LARGE_K:
        part = F.pmod(F.xxhash64(*keys), F.lit(_MERGE_PARTS))
        window = Window.partitionBy(query_id, "__part").orderBy(*best_first)
        candidates = (
            candidates.withColumn("__part", part)
            .withColumn("rk", F.row_number().over(window))
            .filter(F.col("rk") <= k)
            .drop("rk", "__part")
        )
    window = Window.partitionBy(query_id).orderBy(*best_first)
    return (
        candidates.withColumn("rk", F.row_number().over(window))
        .filter(F.col("rk") <= k)
        .select(query_id, F.col("rk").cast("long").alias("rk"), *keys, "score")
    )


def bounded(hits: DataFrame, queries: int, k: int) -> DataFrame:
    """Mark hits as small if queries times k, both known, are few."""
    return F.broadcast(hits) if queries * k <= _SMALL_HITS else hits


def fetch_queries(queries: DataFrame, query_id: str, vector: str, limit_bytes: int, limit_rows: int | None = None):
    """The query table if its matrix fits in ``limit_bytes`` and has no more than ``limit_rows``, else None.

    The dimension is asked for, one row of those that have a vector; then at most one
    row more than fits is read, whatever the size of the table.
    """
    size = F.size(vector)
    known = queries.select(size.alias("n")).filter(F.col(vector).isNotNull() & (size > 0)).limit(1).collect()
    if not known:  # nothing to search for
        return queries.select(query_id, vector).limit(0).toArrow()
    most = max(1, limit_bytes // (8 * known[0].n))
    most = most if limit_rows is None else min(most, limit_rows)
    table = queries.select(query_id, vector).limit(most + 1).toArrow()
    return table if table.num_rows <= most else None


def scan_search(
    collection: DataFrame,
    block: QueryBlock,
    hit_schema: T.StructType,
    query_id: str,
    keys: list[str],
    vector: str,
    k: int,
    cell: str | None = None,
) -> DataFrame:
    """Per-task winners for queries held in memory."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(hit_schema)
    # plain arrays: a class of ours would have to be importable on the executors
    shared = collection.sparkSession.sparkContext.broadcast((block.names, block.matrix, block.squares, block.cells))

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestK(QueryBlock(*shared.value), k, keys)
        for batch in batches:
            best.add(batch, vector, cell)
        yield from best.batches(query_id, arrow_schema)

    columns = [*keys, vector, *([cell] if cell else [])]
    return collection.select(*columns).mapInArrow(best_of_task, hit_schema)


@dataclass
class Grid:
    """How both sides are dealt. Cell ``cells[i]`` lies in ``parts[i]`` blocks from ``first[i]`` on; each block has ``turns``."""

    cells: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    blocks: int
    turns: int


def _grid(rows: list[tuple], asked: int, dim: int, share: bool, cores: int, config: SearchConfig) -> Grid:
    """The grid for ``rows`` (cell, vectors), ``asked`` queries of ``dim`` components; cells share blocks or don't.

    A block is no smaller than ``config.block_rows`` unless that overfills a task. More vectors and queries make
    larger blocks until memory ends that, so what travels grows with the input and not with its square.
    """
    rows = sorted(rows)
    sizes = np.array([n for _, n in rows], np.int64)
    every, side = int(sizes.sum()), math.isqrt(_BLOCKS_PER_CORE * cores - 1) + 1
    parts = max(min(-(-every // config.block_rows), side), -(-every // max(1, BLOCK_BYTES // (8 * max(1, dim)))), 1)
    most = max(1, -(-every // parts))
    if share:
        before = np.cumsum(sizes) - sizes
        first = before // most
        last = np.maximum(before + sizes - 1, before) // most
    else:
        spans = np.maximum(1, -(-sizes // most))
        first = np.cumsum(spans) - spans
        last = first + spans - 1
    blocks = int(last[-1]) + 1 if len(rows) else 1
    turns = max(min(-(-asked // config.block_queries), side), min(-(-2 * cores // blocks), asked // _LEAST_TURN), 1)
    return Grid(np.array([c for c, _ in rows]), first, last - first + 1, blocks, turns)


def blocks_of(lists: pa.Array, cells: np.ndarray, first: np.ndarray, parts: np.ndarray) -> pa.Array:
    """For each list of cells, the blocks that hold them: ``list<struct<block, cells>>``, cells by their number."""
    lists = lists.fill_null([]) if lists.null_count else lists
    flat = lists.flatten()
    asked = np.asarray(flat) if len(cells) and cells.dtype.kind in "iu" else np.array(flat.to_pylist(), cells.dtype if len(cells) else object)
    row = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    number = np.minimum(np.searchsorted(cells, asked), max(0, len(cells) - 1))
    held = np.flatnonzero(cells[number] == asked) if len(cells) else np.zeros(0, np.int64)  # cells without rows are in no block
    row, number = row[held], number[held]
    times = parts[number]
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    row, block, number = np.repeat(row, times), np.repeat(first[number], times) + nth, np.repeat(number, times)
    order = np.lexsort((number, block, row))
    row, block, number = row[order], block[order], number[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(block) != 0)]) if len(row) else np.zeros(0, np.int64)
    inner = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(row)].astype(np.int32)), pa.array(number.astype(np.int32)))
    groups = pa.StructArray.from_arrays([pa.array(block[starts].astype(np.int32)), inner], ["block", "cells"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[starts], np.arange(len(lists) + 1)).astype(np.int32)), groups)


class HeldBlock:
    """The vectors of a block, sorted by cell, that queries stream past."""

    def __init__(self, table: pa.Table, vector: str, keys: list[str], cell: str):
        self.rows, matrix, self.squares, cells = prepared(table, vector, keys, cell)
        narrow = pa.types.is_float32(table.schema.field(vector).type.value_type)
        self.units = (matrix / np.sqrt(self.squares)[:, None]).astype(np.float32) if len(matrix) else matrix
        self.matrix = matrix.astype(np.float32) if narrow else matrix  # widened where it is multiplied
        sort = pc.sort_indices(self.rows, sort_keys=[(c, "ascending") for c in keys])
        self.place = np.empty(len(self.squares), np.int64)  # ties go to the smaller key
        self.place[np.asarray(sort)] = np.arange(len(self.squares))
        cuts = np.flatnonzero(np.diff(cells)) + 1
        self.spans = {int(cells[a]): (int(a), int(b)) for a, b in zip([0, *cuts], [*cuts, len(cells)]) if a < b}

    def search(self, names: pa.Array, vectors: pa.Array, lists: pa.Array | None, k: int) -> Iterator[tuple]:
        """(names, rows, scores) of the ``k`` best for some queries at a time; with ``lists``, of the listed cells."""
        matrix, usable = matrix_of(vectors)
        squares = (matrix * matrix).sum(axis=1)
        good = np.flatnonzero(squares > 0)
        if not len(good) or not len(self.squares):
            return
        if matrix.shape[1] != self.matrix.shape[1]:
            raise ValueError(f"query dimension {matrix.shape[1]}, vector dimension {self.matrix.shape[1]}")
        matrix, squares, names = matrix[good], squares[good], names.take(pa.array(usable[good]))
        if lists is not None:
            lists = lists.take(pa.array(usable[good]))
        for at in range(0, len(squares), _QUERIES_AT_ONCE):
            here = slice(at, at + _QUERIES_AT_ONCE)
            n = len(squares[here])
            if lists is None:
                asking = [(np.arange(n), 0, len(self.squares))]
            else:
                some = lists.slice(at, n)
                row = np.repeat(np.arange(n), np.diff(np.asarray(some.offsets)))
                cell = np.asarray(some.flatten())
                order = np.argsort(cell, kind="stable")
                row, cell = row[order], cell[order]
                cuts = np.flatnonzero(np.r_[True, np.diff(cell) != 0]) if len(cell) else []
                asking = [(row[a:b], *self.spans[int(cell[a])]) for a, b in zip(cuts, [*cuts[1:], len(cell)]) if int(cell[a]) in self.spans]
            q, r, s = self._best(matrix[here], squares[here], asking, k)
            yield names.take(pa.array(q + at)), self.rows.take(pa.array(r)), s

    def _best(self, matrix: np.ndarray, squares: np.ndarray, asking: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        units = (matrix / np.sqrt(squares)[:, None]).astype(np.float32)
        margin = MARGIN_32 * (matrix.shape[1] + 4)
        floor = np.full(len(squares), -np.inf)
        best, more, waiting = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), [], 0
        for rows, start, end in asking:
            mine = units if len(rows) == len(units) else units[rows]
            for at in range(start, end, _VECTORS_AT_ONCE):
                scores = mine @ self.units[at : min(end, at + _VECTORS_AT_ONCE)].T
                wide = scores.shape[1]
                least = (floor[rows] - margin).astype(np.float32)
                open_ = np.flatnonzero(np.isneginf(least))  # queries without k hits yet
                if wide > k and len(open_):
                    least[open_] = np.partition(scores[open_], wide - k, axis=1)[:, wide - k] - np.float32(margin)
                hits = np.flatnonzero(scores >= least[:, None])
                if wide > k and len(hits) > 4 * k * len(rows):  # rising scores: the best of this slab only
                    kth = np.partition(scores, wide - k, axis=1)[:, wide - k] - np.float32(margin)
                    hits = np.flatnonzero(scores >= np.maximum(least, kth)[:, None])
                if len(hits):
                    qi, ri = rows[hits // wide], hits % wide + at
                    more.append((qi, ri, _cosines(matrix, squares, self.matrix, self.squares, qi, ri)))
                    waiting += len(hits)
                if more and (len(open_) or waiting > 2 * k * len(units)):
                    best, more, waiting = self._merge([best, *more], floor, k), [], 0
        return self._merge([best, *more], floor, k) if more else best

    def _merge(self, found: list[tuple], floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, r, s = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((self.place[r], -s, q))
        q, r, s = q[order], r[order], s[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        full = nth == k - 1
        floor[q[full]] = s[full]
        keep = nth < k
        return q[keep], r[keep], s[keep]


def block_search(
    collection: DataFrame,
    asked: DataFrame,
    hit_schema: T.StructType,
    query_id: str,
    keys: list[str],
    vector: str,
    query_vector: str,
    config: SearchConfig,
    cell: str | None = None,
    cells: str | None = None,
    share: bool = True,
) -> DataFrame:
    """Winners per block: of all rows, or of those whose ``cell`` is in the query's list ``cells``.

    Neither a hot cell nor a hot query set ends up in one task. With ``share`` false, no block holds rows of
    two cells, and vectors may differ in dimension from cell to cell.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = collection.sparkSession
    arrow_schema = to_arrow_schema(hit_schema)
    size = asked.agg(F.count("*").alias("n"), F.max(F.size(query_vector)).alias("dim")).head()
    # at most a row a centroid or model
    rows = [(0, collection.count())] if cell is None else [tuple(r) for r in collection.filter(F.col(cell).isNotNull()).groupBy(cell).count().collect()]
    grid = _grid(rows, size.n, size.dim or 0, share, spark.sparkContext.defaultParallelism, config)
    total = min(grid.blocks * grid.turns, _MOST_PARTITIONS)
    listed = cell is not None and share

    # floats travel as floats and are widened in the kernel
    kinds = {collection.schema[vector].dataType.simpleString(), asked.schema[query_vector].dataType.simpleString()}
    shipped = kinds.pop() if len(kinds) == 1 else "array<double>"
    null_keys = [F.lit(None).cast(collection.schema[c].dataType).alias(c) for c in keys]
    no_query = F.lit(None).cast(asked.schema[query_id].dataType).alias(query_id)
    if cell is None:
        placed = collection.withColumns({"__no": F.lit(0), "__first": F.lit(0), "__parts": F.lit(int(grid.parts[0]))})
        meets = asked.withColumn("__m", F.explode(F.sequence(F.lit(0), F.lit(grid.blocks - 1))))
        meets = meets.select(query_id, query_vector, F.col("__m").alias("__part"), F.lit(None).cast("array<int>").alias("__cells"))
    else:
        kind = collection.schema[cell].dataType.simpleString()
        table = [(c, i, f, p) for i, (c, f, p) in enumerate(zip(grid.cells.tolist(), grid.first.tolist(), grid.parts.tolist()))]
        table = spark.createDataFrame(table, f"`{cell}` {kind}, __no int, __first int, __parts int")
        placed = collection.join(F.broadcast(table), cell)
        shared = spark.sparkContext.broadcast((grid.cells, grid.first, grid.parts))

        @F.arrow_udf("array<struct<block:int,cells:array<int>>>")
        def meet(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for lists in batches:
                yield blocks_of(lists, *shared.value)

        meets = asked.withColumn("__m", F.explode(meet(F.col(cells))))
        none = F.lit(None).cast("array<int>")
        meets = meets.select(query_id, query_vector, F.col("__m.block").alias("__part"), (F.col("__m.cells") if listed else none).alias("__cells"))

    turn = F.explode(F.sequence(F.lit(0), F.lit(grid.turns - 1)))
    part = (F.col("__first") + F.pmod(F.xxhash64(*keys), F.col("__parts"))).cast("int")
    left = placed.select("*", turn.alias("__turn")).select(
        (part * grid.turns + F.col("__turn")).alias("__block"),
        F.lit(0).alias("__side"),
        F.col("__no") if listed else F.lit(0).alias("__no"),
        no_query,
        *keys,
        F.col(vector).cast(shipped).alias("__v"),
        F.lit(None).cast("array<int>").alias("__cells"),
    )
    right = meets.select(
        (F.col("__part") * grid.turns + F.pmod(F.xxhash64(query_id), F.lit(grid.turns))).cast("int").alias("__block"),
        F.lit(1).alias("__side"),
        F.lit(0).alias("__no"),
        query_id,
        *null_keys,
        F.col(query_vector).cast(shipped).alias("__v"),
        "__cells",
    )
    together = left.unionByName(right).repartitionById(total, F.pmod("__block", F.lit(total)).cast("int"))
    together = together.sortWithinPartitions("__block", "__side", "__no")
    k = config.k

    def best_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        held_block = None
        vectors: HeldBlock | None = None
        for batch in batches:
            code = np.asarray(batch.column("__block"))
            side = np.asarray(batch.column("__side"))
            cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(side) != 0)) + 1
            for at, end in zip([0, *cuts], [*cuts, len(code)]):
                part = pa.Table.from_batches([batch.slice(at, end - at)])
                if code[at] != held_block:
                    held, held_block, vectors = [], code[at], None
                if side[at] == 0:
                    held.append(part.select([*keys, "__v", "__no"]))
                    continue
                if vectors is None:
                    if not held:
                        continue
                    vectors, held = HeldBlock(pa.concat_tables(held).combine_chunks(), "__v", keys, "__no"), [part.slice(0, 0)]
                asked_here = part.combine_chunks()
                lists = asked_here.column("__cells").combine_chunks() if listed else None
                for names, rows, scores in vectors.search(asked_here.column(query_id).combine_chunks(), asked_here.column("__v"), lists, k):
                    out = pa.table({query_id: names, **{c: rows.column(c) for c in keys}, "score": pa.array(scores)})
                    yield from out.select(arrow_schema.names).cast(arrow_schema).to_batches(max_chunksize=_EMIT_ROWS)

    return together.mapInArrow(best_of_blocks, hit_schema)


def _tasks(collection: DataFrame) -> int:
    """About as many tasks as the scan of the collection will have: no fewer than its files."""
    return max(len(collection.inputFiles()), collection.sparkSession.sparkContext.defaultParallelism)


def top_k(
    collection: DataFrame,
    queries: DataFrame,
    keys: list[str],
    query_id: str = "qid",
    vector: str = "embedding",
    query_vector: str = "embedding",
    config: SearchConfig = SearchConfig(),
) -> DataFrame:
    """Exact search: ``query_id, rk, keys..., score`` for each query.

    Only keys and vectors are read; join texts back to the winners. Filter the
    collection before the call for a filtered search.
    """
    hit_schema = _hit_schema(queries, query_id, collection, keys)
    table = fetch_queries(queries, query_id, query_vector, config.broadcast_bytes, _SCAN_QUERIES)
    if table is not None and table.num_rows * config.k * _tasks(collection) <= config.candidate_rows:
        block = QueryBlock.of(table.column(query_id), table.column(query_vector))
        winners = scan_search(collection, block, hit_schema, query_id, keys, vector, config.k)
        return bounded(rank(winners, query_id, keys, config.k), table.num_rows, config.k)
    queries = queries.select(query_id, query_vector)
    winners = block_search(collection.select(*keys, vector), queries, hit_schema, query_id, keys, vector, query_vector, config)
    return rank(winners, query_id, keys, config.k)


def top_k_by_model(
    collection: DataFrame,
    queries: DataFrame,
    keys: list[str],
    model: str = "model",
    query_id: str = "qid",
    vector: str = "embedding",
    query_vector: str = "embedding",
    config: SearchConfig = SearchConfig(),
) -> DataFrame:
    """Exact search where each query meets the vectors of its own model only: all models in one plan.

    Models may differ in dimension; a block of vectors never holds two of them. ``query_id`` must be
    unique over all models. Rows and queries without a model aren't found.
    """
    hit_schema = _hit_schema(queries, query_id, collection, keys)
    asked = queries.select(query_id, query_vector, model).filter(F.col(model).isNotNull())
    wanted = [r[0] for r in asked.select(model).distinct().limit(_LISTED_MODELS + 1).collect()]
    if len(wanted) <= _LISTED_MODELS:  # read only these models' folders
        collection = collection.filter(F.col(model).isin(wanted))
    asked = asked.select(query_id, query_vector, F.array(model).alias("__models"))
    rows = collection.filter(F.col(model).isNotNull()).select(*keys, vector, model)
    winners = block_search(rows, asked, hit_schema, query_id, keys, vector, query_vector, config, model, "__models", share=False)
    return rank(winners, query_id, keys, config.k)


def top_k_of(
    collection: DataFrame, query_vector: list[float], keys: list[str], vector: str = "embedding", k: int = 5
) -> DataFrame:
    """Exact search for one vector: ``keys..., score``, best first."""
    schema = T.StructType(
        [T.StructField("qid", T.LongType())]
        + [T.StructField(c, collection.schema[c].dataType) for c in keys]
        + [T.StructField("score", T.DoubleType())]
    )
    block = QueryBlock.of(pa.array([0]), pa.array([[float(x) for x in query_vector]], pa.list_(pa.float64())))
    winners = scan_search(collection, block, schema, "qid", keys, vector, k)
    return winners.drop("qid").orderBy(F.col("score").desc(), *keys).limit(k)


def gather_hits(questions: DataFrame, hits: DataFrame, query_id: str = "qid") -> DataFrame:
    """Questions with their hits, best first, as ``array<struct>`` (empty without hits).

    The lists hold at most ``k`` hits each.
    """
    row = F.struct("rk", *[c for c in hits.columns if c not in (query_id, "rk")])
    lists = hits.groupBy(query_id).agg(F.array_sort(F.collect_list(row)).alias("hits"))
    return questions.join(lists, query_id, "left").withColumn("hits", F.coalesce(F.col("hits"), F.array()))
