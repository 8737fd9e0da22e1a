"""Cells that know their statistics: training, exact search by pruned cells, how many cells to probe.

A cell's row in the cell table is (cell_id, centroid, n, total, reach): the unit centroid, the
number of vectors, the sum of their unit vectors, and the smallest cosine of a member to the
centroid. All but the centroid are mergeable, so an append adds its own statistics to the stored
ones and nothing is read again.

By the triangle inequality for angles, a query at angle a to the centroid is at least a - r from
every member of a cell of angular radius r. A query walks its cells from the highest bound down and
stops when no unread cell can hold anything above its k-th score, so the hits are those of the exact
search. How much that saves depends on the data: nothing on vectors without structure, most of the
work on clustered ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import SearchConfig
from ..functions.vectors import not_zero
from ..session import materialise
from .ivf import CELL, Centroids, _in_cells, _typed_nulls, assign_cells
from .search import _SCAN_QUERIES, MARGIN, SCORES_AT_ONCE, QueryBlock, _hit_schema, block_search, fetch_queries, matrix_of, rank, scan_search, top_k

CELL_TABLE = f"{CELL} int, centroid array<double>, n long, total array<double>, reach double"
#: Angles of float vectors are good to about this.
ANGLE_MARGIN = 1e-7
#: Each round of a pruned search looks at so many times more cells than the one before.
GROWTH = 4


# ---- statistics ------------------------------------------------------------------------


def statistics(indexed: DataFrame, centroids: DataFrame, vector: str = "embedding") -> DataFrame:
    """(cell_id, centroid, n, total, reach) of the rows of ``indexed``; cells without rows are left out.

    ``centroids`` has a row a cell and must fit the limit of :class:`Centroids`. Every task hands in one
    partial row a cell it saw; sums are merged by cell and dimension.
    """
    known = Centroids(centroids)
    shared = indexed.sparkSession.sparkContext.broadcast(known.arrays)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, units = shared.value
        order = np.argsort(cells)
        totals: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        reach: dict[int, float] = {}
        for batch in batches:
            matrix, usable = matrix_of(batch.column(vector))
            if not len(usable):
                continue
            norms = np.sqrt((matrix * matrix).sum(axis=1))
            cell = np.asarray(batch.column(CELL).fill_null(-1))[usable]
            good = (norms > 0) & (cell >= 0)
            matrix, cell = matrix[good] / norms[good, None], cell[good]
            for c in np.unique(cell):
                rows = matrix[cell == c]
                at = order[np.searchsorted(cells, c, sorter=order)]
                totals[c] = totals.get(c, 0.0) + rows.sum(axis=0)
                counts[c] = counts.get(c, 0) + len(rows)
                reach[c] = min(reach.get(c, 1.0), float((rows @ units[at]).min()))
        if counts:
            found = sorted(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found, pa.int32()),
                    pa.array([counts[c] for c in found], pa.int64()),
                    pa.array([totals[c].tolist() for c in found], pa.list_(pa.float64())),
                    pa.array([reach[c] for c in found], pa.float64()),
                ],
                [CELL, "n", "total", "reach"],
            )

    parts = indexed.select(CELL, vector).mapInArrow(partial, f"{CELL} int, n long, total array<double>, reach double")
    parts = materialise(parts, "cell-parts")  # short: a row a cell and task
    table = known.table(indexed.sparkSession)
    return merge_parts(parts).join(F.broadcast(table), CELL).select(CELL, "centroid", "n", "total", "reach")


def merge_parts(parts: DataFrame) -> DataFrame:
    """(cell_id, n, total, reach) of a cell from those of parts of it, a stored table."""
    sums = parts.select(CELL, F.posexplode("total").alias("dim", "x")).groupBy(CELL, "dim").agg(F.sum("x").alias("x"))
    totals = sums.groupBy(CELL).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("total"))
    counts = parts.groupBy(CELL).agg(F.sum("n").alias("n"), F.min("reach").alias("reach"))
    return counts.join(totals, CELL).select(CELL, "n", "total", "reach")


def merged(cells: DataFrame, more: DataFrame) -> DataFrame:
    """The cell table after rows with the statistics ``more`` came in; centroids stay."""
    both = materialise(cells.unionByName(more), "cell-parts")
    centroids = both.groupBy(CELL).agg(F.first("centroid").alias("centroid"))
    return merge_parts(both.drop("centroid")).join(centroids, CELL).select(CELL, "centroid", "n", "total", "reach")


# ---- training -----------------------------------------------------------------------------


def lloyd_centroids(
    vectors: DataFrame, key: str, nlist: int, iterations: int = 3, vector: str = "embedding", digits: int = 6
) -> DataFrame:
    """(cell_id, centroid) by Lloyd's rounds over all rows, the same in every run.

    The first centroids are the ``nlist`` vectors whose ids have the smallest MD5, which is a draw over the whole
    table and no prefix of it. Each round assigns every row and takes the means, rounded so that the
    order of the sums doesn't show; a cell that lost all its rows keeps its place.
    """
    usable = vectors.filter(not_zero(F.col(vector)))
    drawn = usable.select(F.md5(F.col(key).cast("string").cast("binary")).alias("h"), F.col(vector).cast("array<double>").alias("centroid"))
    drawn = drawn.orderBy("h").limit(nlist)
    now = drawn.select((F.row_number().over(Window.orderBy("h")) - 1).alias(CELL), "centroid")  # nlist rows
    now = materialise(now, "centroids")
    for _ in range(iterations):
        stats = statistics(assign_cells(usable.select(vector), Centroids(now), vector), now, vector)
        means = stats.select(CELL, F.transform("total", lambda x: F.round(x / F.col("n"), digits)).alias("mean"))
        moved = now.join(means, CELL, "left").select(CELL, F.coalesce("mean", "centroid").alias("centroid"))
        # opposite vectors can cancel out; such a centroid stays as well
        moved = now.withColumnRenamed("centroid", "was").join(moved, CELL)
        moved = moved.select(CELL, F.when(not_zero(F.col("centroid")), F.col("centroid")).otherwise(F.col("was")).alias("centroid"))
        now = materialise(moved, "centroids")
    return now


def probes_for_recall(
    indexed: DataFrame, centroids: Centroids, sample: DataFrame, keys: list[str], target: float = 0.95,
    query_id: str = "qid", vector: str = "embedding", query_vector: str = "embedding", config: SearchConfig = SearchConfig(),
) -> int:
    """How many of its closest cells a query must look into so that ``target`` of the exact hits are found.

    Measured, not guessed: the exact hits of the ``sample`` queries against all rows, and at which place of
    the query's list of cells each hit's cell stands.
    """
    hits = top_k(indexed, sample, keys, query_id, vector, query_vector, config)
    placed = hits.join(indexed.select(*keys, CELL), keys).join(sample.select(query_id, F.col(query_vector).alias("__q")), query_id)
    shared = indexed.sparkSession.sparkContext.broadcast(centroids.arrays)

    @F.arrow_udf("long")
    def place(vectors: pa.Array, cells: pa.Array) -> pa.Array:
        c = Centroids.from_arrays(shared.value)
        matrix, usable = matrix_of(vectors)
        order = c.probes(matrix, len(c.cells))
        found = (order == np.asarray(cells)[usable][:, None]).argmax(axis=1) + 1
        out = np.zeros(len(vectors), np.int64)
        out[usable] = found
        return pa.array(out)

    places = placed.select(place(F.col("__q"), F.col(CELL)).alias("place")).groupBy("place").count().orderBy("place").collect()
    every, seen = sum(r["count"] for r in places), 0  # at most a row a cell
    for r in places:
        seen += r["count"]
        if seen >= target * every:
            return int(r["place"])
    return len(centroids.cells)


# ---- exact search by pruned cells -------------------------------------------------------------


@dataclass
class Pruned:
    """``hits`` as of the exact search, and ``reads``: query, cells_read, vectors_read, rounds."""

    hits: DataFrame
    reads: DataFrame

    def shares(self, cells: DataFrame) -> DataFrame:
        """One row: queries, the cells and vectors there are, and which share of them a query read on average."""
        size = cells.agg(F.count("*").alias("cells"), F.sum("n").alias("vectors"))
        read = self.reads.agg(F.count("*").alias("queries"), F.avg("cells_read").alias("c"), F.avg("vectors_read").alias("v"))
        return read.join(F.broadcast(size)).select(
            "queries", "cells", "vectors", F.try_divide("c", "cells").alias("cells_share"), F.try_divide("v", "vectors").alias("vectors_share")
        )


def _walk(arrays: tuple, matrix: np.ndarray, least: np.ndarray, start: int, width: int) -> tuple[list, np.ndarray]:
    """For each query, the cells at ``start`` and on in its walk, and the vectors in them, that may beat ``least``."""
    cells, units, radius, sizes = arrays
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    cosines = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0) @ units.T
    apart = np.arccos(np.clip(cosines, -1.0, 1.0)) - radius[None, :] - ANGLE_MARGIN
    bound = np.cos(np.maximum(0.0, apart)) + MARGIN
    order = np.argsort(-bound, axis=1, kind="stable")[:, start : start + width]
    worth = np.take_along_axis(bound, order, axis=1) >= least[:, None]
    return [cells[o[w]] for o, w in zip(order, worth)], np.where(worth, sizes[order], 0).sum(axis=1)


def cell_arrays(cells: DataFrame) -> tuple:
    """The cell table as arrays: ids, unit centroids, radius, sizes. Checked like all centroids; a short row each."""
    known = Centroids(cells)
    more = {r[CELL]: (r["reach"], r["n"]) for r in cells.select(CELL, "reach", "n").collect()}
    reach = np.array([more[c][0] for c in known.cells.tolist()], float)
    sizes = np.array([more[c][1] for c in known.cells.tolist()], np.int64)
    return known.cells, known.units, np.arccos(np.clip(reach, -1.0, 1.0)), sizes


def pruned_top_k(
    indexed: DataFrame,
    queries: DataFrame,
    cells: DataFrame,
    keys: list[str],
    query_id: str = "qid",
    vector: str = "embedding",
    query_vector: str = "embedding",
    config: SearchConfig = SearchConfig(),
) -> Pruned:
    """Exact search that reads a cell only for queries whose k-th score it may beat.

    In rounds: the ``config.nprobe`` cells of the highest bounds, then GROWTH times more, until no
    unread cell's bound reaches any query's k-th score. ``indexed``, stored by cell, is read by folder.
    ``query_id`` must be unique.
    """
    spark = indexed.sparkSession
    hit_schema = _hit_schema(queries, query_id, indexed, keys)
    arrays = cell_arrays(cells)
    shared = spark.sparkContext.broadcast(arrays)
    most = len(arrays[0])
    queries = queries.filter(not_zero(F.col(query_vector))).select(query_id, query_vector)
    found, reads = indexed.limit(0).select(*_typed_nulls(hit_schema)), None
    found = materialise(rank(found, query_id, keys, config.k), "pruned")
    start, width = 0, max(1, config.nprobe)
    while start < most:
        at, wide = start, width

        @F.arrow_udf("struct<cells:array<int>,vectors:long>")
        def walk(vectors: pa.Array, least: pa.Array) -> pa.Array:
            matrix, usable = matrix_of(vectors)
            cells_of: list = [[] for _ in range(len(vectors))]
            sizes = np.zeros(len(vectors), np.int64)
            known = least.fill_null(-np.inf).to_numpy(zero_copy_only=False)
            step = max(1, SCORES_AT_ONCE // max(1, most))
            for i in range(0, len(usable), step):
                rows = usable[i : i + step]
                cells_found, n = _walk(shared.value, matrix[i : i + step], known[rows], at, wide)
                sizes[rows] = n
                for r, c in zip(rows, cells_found):
                    cells_of[r] = c
            return pa.StructArray.from_arrays([pa.array(cells_of, pa.list_(pa.int32())), pa.array(sizes)], ["cells", "vectors"])

        kth = found.where(F.col("rk") == config.k).select(query_id, F.col("score").alias("__least"))
        asked = queries.join(kth, query_id, "left").withColumn("__walk", walk(F.col(query_vector), F.col("__least")))
        asked = asked.select(query_id, query_vector, F.col("__walk.cells").alias("__cells"), F.col("__walk.vectors").alias("__n"))
        asked = materialise(asked.where(F.size("__cells") > 0), "asked")
        read = asked.select(query_id, F.size("__cells").alias("cells_read"), F.col("__n").alias("vectors_read"))
        reads = read if reads is None else reads.unionByName(read)
        winners = _round(indexed, asked, hit_schema, keys, query_id, vector, query_vector, config)
        if winners is None:
            break
        together = found.drop("rk").select(*hit_schema.names).unionByName(winners)
        found = materialise(rank(together, query_id, keys, config.k), "pruned")
        start, width = start + width, width * GROWTH
    if reads is None:
        reads = queries.limit(0).select(query_id, F.lit(0).alias("cells_read"), F.lit(0).alias("vectors_read"))
    totals = reads.groupBy(query_id).agg(*[F.sum(c).cast("long").alias(c) for c in ("cells_read", "vectors_read")], F.count("*").alias("rounds"))
    return Pruned(found, totals)


def _round(indexed, asked, hit_schema, keys, query_id, vector, query_vector, config) -> DataFrame | None:
    """Winners among the rows of the cells that each query asks for; None if none is asked for."""
    wanted = sorted(r[0] for r in asked.select(F.explode("__cells")).distinct().collect())  # at most all cells
    if not wanted:
        return None
    rows = _in_cells(indexed, wanted)
    table = fetch_queries(asked, query_id, query_vector, config.broadcast_bytes, _SCAN_QUERIES)
    if table is not None and table.num_rows * len(wanted) <= SCORES_AT_ONCE:
        lists = {r[query_id]: r["__cells"] for r in asked.select(query_id, "__cells").collect()}
        block = QueryBlock.of(table.column(query_id), table.column(query_vector))
        widest = max(map(len, lists.values()))
        block.cells = np.array([lists[q] + [-1] * (widest - len(lists[q])) for q in block.names.to_pylist()], np.int32)
        return scan_search(rows, block, hit_schema, query_id, keys, vector, config.k, CELL)
    rows = rows.select(*keys, vector, CELL)
    return block_search(rows, asked, hit_schema, query_id, keys, vector, query_vector, config, CELL, "__cells")
