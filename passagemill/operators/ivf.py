"""Inverted-file index: centroids, cell of each vector, probed search.

Exact search is the default of this package; an index is opt-in. With
``nprobe >= nlist`` the probed search equals the exact one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BROADCAST_BYTES, NLIST, SearchConfig
from ..functions.vectors import not_zero
from ..session import materialise, spread
from .search import _SCAN_QUERIES, SCORES_AT_ONCE, QueryBlock, _hit_schema, block_search, bounded, fetch_queries, matrix_of, rank, scan_search, top_k

CELL = "cell_id"
#: Vectors, in double precision, of a partition that cells are trained on.
TRAINING_BYTES = 64 * 1024 * 1024


def nlist_rule(rows: Column) -> Column:
    """Number of cells for a collection of this many rows."""
    return F.floor(F.sqrt(rows.cast("double"))).cast("long")


def seed_centroids(vectors: DataFrame, key: str, nlist: int, vector: str = "embedding") -> DataFrame:
    """Deterministic centroids: the first ``nlist`` vectors by key, numbered from 0."""
    first = vectors.filter(not_zero(F.col(vector))).orderBy(key).limit(nlist)
    return first.agg(F.array_sort(F.collect_list(F.struct(key, vector))).alias("c")).select(
        F.posexplode(F.transform("c", lambda c: c[vector])).alias(CELL, "centroid")
    )


def train_centroids(
    vectors: DataFrame,
    nlist: int = NLIST,
    vector: str = "embedding",
    seed: int = 42,
    iterations: int = 10,
    rows_per_cell: int | None = None,
) -> DataFrame:
    """KMeans on the unit vectors.

    All rows take part unless the caller asks for about ``rows_per_cell * nlist``
    random ones. Which rows were drawn changes the cut of the cells, never their
    content: every row is assigned to a cell later.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    drawn = vectors.select(vector)
    if rows_per_cell is not None:
        fraction = rows_per_cell * nlist / max(1, vectors.count())
        if fraction < 1.0:
            drawn = drawn.sample(fraction=fraction, seed=seed)
    points = drawn.filter(not_zero(F.col(vector))).select(array_to_vector(F.col(vector)).alias("raw"))
    points = Normalizer(inputCol="raw", outputCol="features").transform(points).select("features")
    points = materialise(spread(points), "training")
    first = points.head()
    parts = -(-points.count() * 8 * (len(first.features) if first else 0) // TRAINING_BYTES)
    # held here and not by KMeans, which would deal the rows anew for each of its jobs and hold a partition as one block
    points = points.repartition(max(parts, points.sparkSession.sparkContext.defaultParallelism)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=max(2, nlist), seed=seed, maxIter=iterations, featuresCol="features").fit(points)
    finally:
        points.unpersist()
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(rows, f"{CELL} int, centroid array<double>")


class Centroids:
    """Centroids held in memory, as unit vectors ordered by cell.

    Tasks get ``arrays``: broadcast classes would have to be importable there.
    """

    def __init__(self, table: DataFrame, limit_bytes: int = BROADCAST_BYTES):
        found = fetch_queries(table, CELL, "centroid", limit_bytes)
        if found is None:
            raise ValueError(f"the centroids take more than {limit_bytes} bytes; see assign_cells_of")
        found = found.sort_by(CELL)
        matrix, usable = matrix_of(found.column("centroid"))
        self.cells = np.asarray(found.column(CELL))[usable].astype(np.int32)
        norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
        self.units = np.divide(matrix, norms, out=matrix.copy(), where=norms > 0)

    @property
    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.cells, self.units

    def table(self, spark: SparkSession) -> DataFrame:
        """(cell_id, centroid) with unit centroids."""
        rows = [(int(c), [float(x) for x in u]) for c, u in zip(self.cells, self.units)]
        return spark.createDataFrame(rows, f"{CELL} int, centroid array<double>")

    @staticmethod
    def from_arrays(arrays: tuple[np.ndarray, np.ndarray]) -> Centroids:
        made = object.__new__(Centroids)
        made.cells, made.units = arrays
        return made

    def _in_slices(self, matrix: np.ndarray, pick) -> np.ndarray:
        """``pick`` on the cosines of a slice of rows, so that memory stays bounded."""
        step = max(1, SCORES_AT_ONCE // max(1, len(self.cells)))
        parts = [pick(matrix[at : at + step] @ self.units.T) for at in range(0, max(1, len(matrix)), step)]
        return self.cells[np.concatenate(parts)]

    def nearest(self, matrix: np.ndarray) -> np.ndarray:
        """Closest cell per row by cosine; ties go to the lower cell."""
        return self._in_slices(matrix, lambda cosines: np.argmax(cosines, axis=1))

    def probes(self, matrix: np.ndarray, nprobe: int) -> np.ndarray:
        """The ``nprobe`` closest cells per row, closest first."""
        n = min(nprobe, len(self.cells))
        return self._in_slices(matrix, lambda cosines: np.argsort(-cosines, axis=1, kind="stable")[:, :n])


def assign_cells(df: DataFrame, centroids: Centroids, vector: str = "embedding") -> DataFrame:
    """Add ``cell_id``; null for a null or zero vector, which no search returns."""
    shared = df.sparkSession.sparkContext.broadcast(centroids.arrays)

    @F.arrow_udf("int")
    def nearest_cell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = Centroids.from_arrays(shared.value)
        for vectors in batches:
            matrix, usable = matrix_of(vectors)
            cells = np.zeros(len(vectors), dtype=np.int32)
            known = np.zeros(len(vectors), dtype=bool)
            if len(usable):
                nonzero = (matrix != 0).any(axis=1)
                cells[usable[nonzero]] = c.nearest(matrix[nonzero])
                known[usable[nonzero]] = True
            yield pa.array(cells, pa.int32(), mask=~known)

    return df.withColumn(CELL, nearest_cell(F.col(vector)))


def assign_cells_of(df: DataFrame, centroids: DataFrame, key: str, vector: str = "embedding",
                    config: SearchConfig = SearchConfig()) -> DataFrame:
    """Add ``cell_id`` from a centroid table of any size: the exact search for one neighbour.

    Used where the centroids are too many for :class:`Centroids`. ``key`` must be unique.
    """
    one = replace(config, k=1)
    unit = centroids.filter(not_zero(F.col("centroid")))
    found = top_k(unit, df.select(key, vector), [CELL], query_id=key, vector="centroid", query_vector=vector, config=one)
    return df.join(found.select(key, CELL), key, "left")


def probed_top_k(
    indexed: DataFrame,
    queries: DataFrame,
    centroids: Centroids,
    keys: list[str],
    query_id: str = "qid",
    vector: str = "embedding",
    query_vector: str = "embedding",
    config: SearchConfig = SearchConfig(),
) -> DataFrame:
    """Search the ``config.nprobe`` closest cells of each query.

    ``indexed`` carries ``cell_id``; stored partitioned by it, only probed cells
    are read.
    """
    hit_schema = _hit_schema(queries, query_id, indexed, keys)
    table = fetch_queries(queries, query_id, query_vector, config.broadcast_bytes, _SCAN_QUERIES)
    if table is not None:
        block = QueryBlock.of(table.column(query_id), table.column(query_vector))
        if not len(block.squares):
            return rank(indexed.limit(0).select(*_typed_nulls(hit_schema)), query_id, keys, config.k)
        block.cells = centroids.probes(block.matrix, config.nprobe)
        wanted = np.unique(block.cells)
        if len(wanted) < len(centroids.cells):
            indexed = _in_cells(indexed, [int(c) for c in wanted])
        winners = scan_search(indexed, block, hit_schema, query_id, keys, vector, config.k, CELL)
        return bounded(rank(winners, query_id, keys, config.k), table.num_rows, config.k)
    winners = _probed_blocks(
        indexed, queries, centroids, hit_schema, keys, query_id, vector, query_vector, config
    )
    return rank(winners, query_id, keys, config.k)


#: Cells up to which a list in a filter prunes the folders; beyond, a join does it row by row.
_LISTED_CELLS = 10_000


def _in_cells(indexed: DataFrame, cells: list[int]) -> DataFrame:
    """Rows of the given cells, at most one a centroid."""
    if len(cells) <= _LISTED_CELLS:
        return indexed.filter(F.col(CELL).isin(cells))
    wanted = indexed.sparkSession.createDataFrame([(c,) for c in cells], f"{CELL} int")
    return indexed.join(F.broadcast(wanted), CELL, "left_semi")


def _typed_nulls(schema) -> list[Column]:
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]


def _probed_blocks(
    indexed, queries, centroids, hit_schema, keys, query_id, vector, query_vector, config
) -> DataFrame:
    """Each query meets the blocks of its own cells only, and there these cells."""
    shared = indexed.sparkSession.sparkContext.broadcast(centroids.arrays)
    nprobe = config.nprobe

    @F.arrow_udf("array<int>")
    def probe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = Centroids.from_arrays(shared.value)
        for vectors in batches:
            matrix, usable = matrix_of(vectors)
            found: list = [None] * len(vectors)
            if len(usable):
                for i, cells in zip(usable, c.probes(matrix, nprobe)):
                    found[i] = cells
            yield pa.array(found, pa.list_(pa.int32()))

    asked = materialise(queries.select(query_id, query_vector, probe(F.col(query_vector)).alias("__cells")), "probes")
    wanted = [r[0] for r in asked.select(F.explode("__cells").alias(CELL)).distinct().collect()]  # at most all cells
    rows = _in_cells(indexed, wanted) if len(wanted) < len(centroids.cells) else indexed.filter(F.col(CELL).isNotNull())
    return block_search(
        rows.select(*keys, vector, CELL), asked, hit_schema, query_id, keys, vector, query_vector, config, CELL, "__cells"
    )


def recall(exact: DataFrame, approximate: DataFrame, keys: list[str], query_id: str = "qid") -> DataFrame:
    """Share of the exact hits that the index also found: one row."""
    found = approximate.select(query_id, *keys, F.lit(1).alias("__found"))
    return (
        exact.select(query_id, *keys)
        .join(found, [query_id, *keys], "left")
        .agg(
            F.count("*").alias("expected"),
            F.count("__found").alias("found"),
            F.try_divide(F.count("__found").cast("double"), F.count("*")).alias("recall"),
        )
    )
