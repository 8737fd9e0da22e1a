"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, scratch_path


def _write(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst): the smallest node it reaches.

    Each round a node takes the smallest label among its neighbours and then the label of
    its label, so paths shorten by half at least. Rounds go through written tables;
    only one count a round comes to the driver. Minima are combined before each
    shuffle, and a hot label only meets its one row. An empty table gives no rows.
    """
    spark = edges.sparkSession
    both = edges.select(F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(
        edges.select(F.col("dst").alias("node"), F.col("src").alias("other"))
    )
    labels, path = _write(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("near"))
        step = labels.join(near, "node", "left").select("node", F.least("component", F.coalesce("near", "component")).alias("now"), "component")
        step, step_path = _write(step, "step")
        roots = step.select(F.col("node").alias("root"), F.col("now").alias("up"))
        jumped = step.join(roots, F.col("now") == F.col("root"), "left").select(
            "node", F.least("now", F.coalesce("up", "now")).alias("component"), F.col("component").alias("was")
        )
        after, after_path = _write(jumped, "labels")
        changed = after.where("component <> was").limit(1).count()
        drop_path(spark, path)
        drop_path(spark, step_path)
        labels, path = after.select("node", "component"), after_path
        if not changed:
            return labels
