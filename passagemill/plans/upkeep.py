"""Upkeep of an indexed collection without a rebuild.

A collection ``name`` stored by cell has a table ``name__cells`` of cell statistics beside it (see
:mod:`..operators.cells`). Appends merge their own statistics into it. Cells that have grown over a
bound are split in two, all of them at once, by rounds of 2-means among their own rows; cells
that hold too little hand their rows to the nearest others. Only the folders of those cells are
read and written.

Every step first publishes statistics wide enough for both the old and the new place of a row, then
moves rows in one overwrite of the touched folders, then publishes the exact statistics: a search
at any moment, or after a failure between two steps, finds every row. While starved cells
are merged, a row that has moved can be found twice until its old folder is dropped; running
the upkeep again finishes a broken run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CollectionConfig
from ..operators.cells import lloyd_centroids, merged, statistics
from ..operators.ivf import CELL, Centroids, assign_cells
from ..operators.search import matrix_of
from ..session import materialise
from ..sources import collection as store

#: Rounds of 2-means within a cell that is split.
SPLIT_ROUNDS = 4


@dataclass(frozen=True)
class UpkeepConfig:
    #: A cell of more rows is split, one of fewer is merged; ``least_rows`` well below half of ``most_rows``.
    most_rows: int = 2_000_000
    least_rows: int = 50_000
    key: str = "id"
    vector: str = "embedding"


def cells_config(config: CollectionConfig) -> CollectionConfig:
    return CollectionConfig(f"{config.name}__cells", config.database, config.dim)


def open_cells(spark: SparkSession, config: CollectionConfig) -> DataFrame:
    return store.open_collection(spark, cells_config(config))


def _snapshot(spark: SparkSession, config: CollectionConfig) -> DataFrame:
    """A copy of the cell table, which outlives its replacement."""
    return materialise(open_cells(spark, config), "cells")


def _publish(cells: DataFrame, config: CollectionConfig) -> None:
    """Replace the cell table; it is short, and written aside before the old one goes."""
    store.create_or_replace(cells, cells_config(config))


def create(rows: DataFrame, config: CollectionConfig, nlist: int, upkeep: UpkeepConfig = UpkeepConfig()) -> None:
    """Train cells on all rows, store the rows by cell and the cells' statistics beside them."""
    spark = rows.sparkSession
    centroids = lloyd_centroids(rows, upkeep.key, nlist, vector=upkeep.vector)
    indexed = materialise(assign_cells(rows, Centroids(centroids), upkeep.vector), "indexed")
    store.create_or_replace(indexed, config, CELL)
    _publish(statistics(store.open_collection(spark, config), centroids, upkeep.vector), config)


def append(rows: DataFrame, config: CollectionConfig, upkeep: UpkeepConfig = UpkeepConfig()) -> None:
    """Add rows to their nearest cells; rows whose key is stored already are left out, so a repeat adds nothing."""
    spark = rows.sparkSession
    stored, cells = store.open_collection(spark, config), _snapshot(spark, config)
    keys = materialise(rows.select(upkeep.key).distinct(), "keys")
    known = stored.select(upkeep.key).join(keys, upkeep.key, "left_semi")
    new = assign_cells(rows.join(known, upkeep.key, "left_anti"), Centroids(cells), upkeep.vector)
    new = materialise(new, "append")
    # the statistics first: they may count rows that aren't there yet, never miss one that is
    _publish(merged(cells, statistics(new, cells, upkeep.vector)), config)
    store.append(new.select(*stored.columns), config, CELL)


def split_oversized(spark: SparkSession, config: CollectionConfig, upkeep: UpkeepConfig = UpkeepConfig()) -> int:
    """Split every cell of more than ``most_rows`` until none is left that can be; returns the number of splits.

    A cell of equal vectors can't be split by distance and stays.
    """
    done, stuck = 0, set()
    while True:
        cells = _snapshot(spark, config)
        over = [r[0] for r in cells.where(F.col("n") > upkeep.most_rows).select(CELL).collect() if r[0] not in stuck]
        if not over:
            return done
        next_id = cells.agg(F.max(CELL)).first()[0] + 1
        rows = store.open_collection(spark, config).where(F.col(CELL).isin(over))
        pairs = _two_means(rows, cells, over, upkeep)
        stuck |= set(over) - set(pairs)
        if not pairs:
            continue
        names = {c: (c, next_id + i) for i, c in enumerate(sorted(pairs))}
        sided = _sided(rows.where(F.col(CELL).isin(list(pairs))), pairs, upkeep.vector)
        number = F.create_map(*[F.lit(x) for c, (_, new) in names.items() for x in (c, new)])
        moved = sided.withColumn(CELL, F.when(F.col("__side") == 1, number[F.col(CELL)]).otherwise(F.col(CELL))).drop("__side")
        moved = materialise(moved, "split")
        parents = cells.where(F.col(CELL).isin(list(pairs)))
        twins = parents.withColumn(CELL, number[F.col(CELL)])
        _publish(materialise(cells.unionByName(twins), "cells"), config)
        _overwrite(moved, config)
        centers = [(names[c][s], [float(x) for x in pairs[c][s]]) for c in pairs for s in (0, 1)]
        children = statistics(moved, spark.createDataFrame(centers, f"{CELL} int, centroid array<double>"), upkeep.vector)
        others = cells.where(~F.col(CELL).isin(list(pairs)))
        _publish(materialise(others.unionByName(children), "cells"), config)
        done += len(pairs)


def merge_starved(spark: SparkSession, config: CollectionConfig, upkeep: UpkeepConfig = UpkeepConfig()) -> int:
    """Hand the rows of every cell of fewer than ``least_rows`` to the nearest others; returns the number of merged cells."""
    cells = _snapshot(spark, config)
    starved = [r[0] for r in cells.where(F.col("n") < upkeep.least_rows).select(CELL).collect()]
    staying = cells.where(~F.col(CELL).isin(starved))
    if not starved or staying.isEmpty():
        return 0
    stored = store.open_collection(spark, config)
    columns = [c for c in stored.columns if c != CELL]
    moved = assign_cells(stored.where(F.col(CELL).isin(starved)).select(*columns), Centroids(staying), upkeep.vector)
    moved = materialise(moved.select(*columns, CELL), "merge")
    gained = statistics(moved, staying, upkeep.vector)
    touched = [r[0] for r in gained.select(CELL).collect()]  # at most a row a starved row or cell
    wide = merged(staying, gained)
    _publish(materialise(wide.unionByName(cells.where(F.col(CELL).isin(starved))), "cells"), config)
    # a run that broke off after the overwrite may have moved some of them already
    here = stored.where(F.col(CELL).isin(touched))
    fresh = moved.join(here.select(upkeep.key).join(moved.select(upkeep.key), upkeep.key, "left_semi"), upkeep.key, "left_anti")
    together = materialise(here.select(*columns, CELL).unionByName(fresh.select(*columns, CELL)), "merged")
    _overwrite(together, config)
    exact = statistics(together, staying, upkeep.vector)
    _publish(materialise(staying.where(~F.col(CELL).isin(touched)).unionByName(exact), "cells"), config)
    for c in starved:
        spark.sql(f"ALTER TABLE {store.full_name(config)} DROP IF EXISTS PARTITION ({CELL} = {int(c)})")
    return len(starved)


def maintain(spark: SparkSession, config: CollectionConfig, upkeep: UpkeepConfig = UpkeepConfig()) -> DataFrame:
    """Split what has grown too large, then merge what is too small: one row with splits, merges, cells and rows."""
    splits = split_oversized(spark, config, upkeep)
    merges = merge_starved(spark, config, upkeep)
    cells = open_cells(spark, config).agg(F.count("*").alias("cells"), F.sum("n").alias("rows"), F.max("n").alias("largest"))
    return cells.select(F.lit(splits).cast("long").alias("splits"), F.lit(merges).cast("long").alias("merges"), "*")


def _overwrite(rows: DataFrame, config: CollectionConfig, rows_per_file: int = 1_000_000) -> None:
    """Replace the folders of the cells that ``rows``, a stored table, belong to, and no others."""
    laid = store.even_files(rows, CELL, rows_per_file)
    columns = [c for c in rows.columns if c != CELL] + [CELL]
    # a catalog table takes the mode from the session only
    conf, mode = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        laid.select(*columns).write.insertInto(store.full_name(config), overwrite=True)
    finally:
        conf.set(mode, before)


def _two_means(rows: DataFrame, cells: DataFrame, over: list[int], upkeep: UpkeepConfig) -> dict[int, np.ndarray]:
    """Two unit centers for each of the cells that can be split, by rounds over all of them at once.

    The first two are the member farthest from the centroid and the one farthest from that.
    """
    spark, vector = rows.sparkSession, upkeep.vector
    centers = {r[CELL]: np.array([r["centroid"]]) for r in cells.where(F.col(CELL).isin(over)).select(CELL, "centroid").collect()}
    first = _farthest(rows, centers, upkeep)
    second = _farthest(rows, {c: np.array([v]) for c, v in first.items()}, upkeep)
    centers = {c: np.array([first[c], v]) for c, v in second.items()}
    for _ in range(SPLIT_ROUNDS):
        centers = {c: pair for c, pair in centers.items() if not np.allclose(pair[0], pair[1], atol=1e-12)}
        if not centers:
            return {}
        sides = _sided(rows.where(F.col(CELL).isin(list(centers))), centers, vector)
        # sums by cell and side: a cell's sides are numbered 2 c and 2 c + 1
        numbered = sides.select((F.col(CELL) * 2 + F.col("__side")).cast("int").alias(CELL), vector)
        flat = [(2 * c + s, [float(x) for x in pair[s]]) for c, pair in centers.items() for s in (0, 1)]
        sums = statistics(numbered, spark.createDataFrame(flat, f"{CELL} int, centroid array<double>"), vector)
        means = {r[CELL]: np.array(r["total"]) for r in sums.collect()}
        centers = {
            c: np.array([_unit(means[2 * c]), _unit(means[2 * c + 1])])
            for c in centers
            if 2 * c in means and 2 * c + 1 in means and means[2 * c].any() and means[2 * c + 1].any()
        }
    return centers


def _farthest(rows: DataFrame, centers: dict[int, np.ndarray], upkeep: UpkeepConfig) -> dict[int, np.ndarray]:
    """The unit vector of each cell's member farthest from its center."""
    near = _sided(rows, centers, upkeep.vector, cosine="__cosine")
    far = near.groupBy(CELL).agg(F.min_by(upkeep.vector, F.struct("__cosine", upkeep.key)).alias("v")).collect()
    return {r[CELL]: _unit(np.array(r["v"], float)) for r in far}


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.sqrt((v * v).sum())
    return v / norm if norm > 0 else v


def _sided(rows: DataFrame, centers: dict[int, np.ndarray], vector: str, cosine: str | None = None) -> DataFrame:
    """``rows`` with the number of the closest of its cell's centers, and its cosine to it."""
    shared = rows.sparkSession.sparkContext.broadcast(centers)

    @F.arrow_udf("struct<side:int,cosine:double>")
    def nearest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for cells, vectors in batches:
            matrix, usable = matrix_of(vectors)
            sides, cosines = np.zeros(len(cells), np.int32), np.ones(len(cells))
            numbers = np.asarray(cells)[usable]
            for c in np.unique(numbers):
                at = np.flatnonzero(numbers == c)
                units = matrix[at] / np.maximum(np.sqrt((matrix[at] ** 2).sum(axis=1, keepdims=True)), 1e-300)
                near = units @ shared.value[int(c)].T
                sides[usable[at]], cosines[usable[at]] = near.argmax(axis=1), near.max(axis=1)
            yield pa.StructArray.from_arrays([pa.array(sides), pa.array(cosines)], ["side", "cosine"])

    found = rows.withColumn("__near", nearest(F.col(CELL), F.col(vector))).withColumn("__side", F.col("__near.side"))
    return (found.withColumn(cosine, F.col("__near.cosine")) if cosine else found).drop("__near")
