"""From raw documents to a shuffled, weighted training mix, in five stages.

Each stage takes the written result of the one before and works on all of it; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import passagemill  # noqa: E402
from passagemill.llm import decontaminate, mixing, sharding, simhash, toxicity  # noqa: E402
from passagemill.llm.common import id_remainder, materialise  # noqa: E402

# functions go to the tasks by value, from whatever folder this runs
cloudpickle.register_pickle_by_value(passagemill)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled neighbours call toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, id_remainder("id", 5) != 0)
    own, back = _spared(docs, "score", "predicted")
    scored = toxicity.toxicity(own, model, evidence=False)
    return scored.where("predicted = 0").select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    own, back = _spared(docs, "n_words", "n_hit", "items", "hit_spans", "contaminated")
    found = decontaminate.decontaminate(own, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~F.col("contaminated")).select(*back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    own, back = _spared(docs, "size", "source_size", "target", "copies", "taken")
    return mixing.emit(mixing.mix(own)).select(*back)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in random order, dealt over shards: with shard and slot, in place of columns of that name."""
    return sharding.shard(docs)


def _spared(docs: DataFrame, *results: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns named like an operator's results out of its way, and the columns as they were."""
    names = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in results}
    return docs.withColumnsRenamed(names), [F.col(names.get(c, c)).alias(c) for c in docs.columns]


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between them, tables in the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Nearest neighbours, fingerprints and permutations are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None
