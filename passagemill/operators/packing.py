"""Tasks of equal work: files packed by what they cost, not by how many they are.

Large files, of more than a part of a task's mean, are few for each task; they are dealt first, in falling order, to and fro
over the tasks. What each task then lacks of the mean is its room, and the running total of all other files, cut
into pieces as long as the tasks' rooms, says where each goes. A task so differs from the mean by a small file, unless
large files alone exceed it. The running total is taken over ranges of the order, each in a Spark task of its
own, and over the ranges' sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialise

#: What opening a file costs, in bytes.
FILE_BYTES = 64 * 1024
#: A file of more than this part of the mean is large: there are fewer than LARGE_PARTS a task.
LARGE_PARTS = 8
#: Rows of a range.
_RANGE_ROWS = 500_000


def file_cost(length: str = "length") -> Column:
    """Cost by size, for files that never ran."""
    return F.coalesce(F.col(length), F.lit(0)).cast("double") + FILE_BYTES


def with_cost(files: DataFrame, log: DataFrame | None = None, key: str = "source_key", length: str = "length") -> DataFrame:
    """``files`` with ``cost``: seconds of the last run where its log has the file, else the size at that run's seconds a byte."""
    if log is None:
        return files.withColumn("cost", file_cost(length))
    known = log.where(F.col("duration_s").isNotNull()).groupBy(key).agg(F.max("duration_s").alias("__took"))
    joined = files.join(known, key, "left")
    rate = joined.where("__took is not null").agg(F.try_divide(F.sum("__took"), F.sum(file_cost(length)))).first()[0]
    return joined.withColumn("cost", F.coalesce("__took", file_cost(length) * F.lit(rate or 1.0))).drop("__took")


def running_total(rows: DataFrame, order: list[Column], value: str, out: str) -> DataFrame:
    """``rows``, a stored table, with ``out``: the sum of ``value`` over all rows before, in the whole order."""
    spark = rows.sparkSession
    ranges = max(1 + rows.count() // _RANGE_ROWS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(int(ranges), *order).withColumn("__range", F.spark_partition_id())
    dealt = materialise(dealt, "ranges")
    # a row a range
    sums = dealt.groupBy(F.col("__range").alias("__r")).agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__r", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("__base") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    joined = dealt.withColumn("__inside", F.lit(0)).join(F.broadcast(sums), F.col("__range") == F.col("__r"))
    return joined.withColumn(out, total).drop("__inside", "__range", "__r", "__base")


def pack(files: DataFrame, tasks: int, cost: str = "cost", key: str = "source_key") -> DataFrame:
    """``files``, a stored table, with ``task`` from 0 to ``tasks`` - 1, equal in cost. ``key`` breaks ties and is unique."""
    whole = float(files.agg(F.sum(cost)).first()[0] or 0.0)
    columns, mean = files.columns, whole / tasks
    is_large = F.col(cost) * LARGE_PARTS > mean
    # fewer than LARGE_PARTS * tasks rows
    at = F.row_number().over(Window.orderBy(F.col(cost).desc(), F.col(key))) - 1
    turn, place = F.floor(at / tasks), F.pmod(at, F.lit(tasks))
    large = files.where(is_large).withColumn("task", F.when(turn % 2 == 0, place).otherwise(tasks - 1 - place).cast("int"))
    large = materialise(large, "large")
    small = files.where(~is_large)
    left = float(small.agg(F.sum(cost)).first()[0] or 0.0)
    if not left:
        return large.select(*columns, "task")

    # a row a task: its room, as a piece of the running total of the small files
    held = large.groupBy("task").agg(F.sum(cost).alias("held"))
    rooms = files.sparkSession.range(tasks).select(F.col("id").cast("int").alias("task")).join(held, "task", "left")
    rooms = rooms.withColumn("room", F.greatest(F.lit(mean) - F.coalesce("held", F.lit(0.0)), F.lit(0.0)))
    everything, before = Window.partitionBy(), Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    scale = F.lit(left) / F.sum("room").over(everything)
    rooms = rooms.select(
        "task", (F.coalesce(F.sum("room").over(before), F.lit(0.0)) * scale).alias("from"), (F.sum("room").over(Window.orderBy("task")) * scale).alias("to")
    ).where(F.col("to") > F.col("from"))
    # cells of equal length, each with the few pieces that touch it: a file looks into the cell of its middle only
    cell = lambda x: F.least(F.floor(x * tasks / left), F.lit(tasks - 1)).cast("int")
    last = F.max("task").over(everything) == F.col("task")
    cells = rooms.withColumn("last", last).withColumn("cell", F.explode(F.sequence(cell(F.col("from")), cell(F.col("to")))))
    rows = running_total(materialise(small, "small"), [F.col(cost).desc(), F.col(key)], cost, "__before")
    rows = rows.withColumn("__middle", F.col("__before") + F.col(cost) / 2).withColumn("__cell", cell(F.col("__middle")))
    inside = (F.col("__middle") >= F.col("from")) & ((F.col("__middle") < F.col("to")) | F.col("last"))
    found = rows.join(F.broadcast(cells), (F.col("__cell") == F.col("cell")) & inside)  # at most 2 rows a task
    return found.select(*columns, "task").unionByName(large.select(*columns, "task"))


def placed(packed: DataFrame, tasks: int) -> DataFrame:
    """Each task's files in a partition of their own."""
    return packed.repartitionById(tasks, F.col("task"))
