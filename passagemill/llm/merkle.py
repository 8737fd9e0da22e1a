"""Merkle manifest of a dataset, with nested-interval labels.

Every row is a leaf. Leaves are ranked within their tree (one tree a group, such as a source);
a node is labelled with the interval [lo, hi) of leaf ranks that it covers, so an
ancestor is a node whose interval contains another's, and the siblings of a node are its
parent's interval without its own. A node of level l covers the ranks of one bucket of
FANOUT ** l, so containment is looked up by an equal bucket and confirmed by the
interval. Levels are built from the leaves up, and proofs are handed down from the root, one
join of children with parents a level: a key never has more than FANOUT rows, however
large a group is. The roots of the groups are the leaves of one more tree, whose root stands for
the dataset.

A leaf is the SHA-256 over its fields, each as ``-`` if null and else as its length in UTF-8
bytes, ``:`` and the value; a node is that over its children's digests as hex text. Only
digests and ids are shuffled, never texts. Leaves of a group go by id, none first, and by
digest where ids are equal, so repeated rows are leaves each and the root doesn't depend on the
partitions. The null group is a group, before all others; groups go by their UTF-8 bytes. An
empty table has no leaves, no nodes and no root. Other columns named in ``keep`` pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import join_groups, materialise

FANOUT = 16
#: Leaves that one task ranks at a time, about.
LEAVES_A_RANGE = 250_000
RESULTS = ("leaf", "subroot", "root", "steps")
STEPS = "array<struct<left:string,right:string>>"


def field(c: Column) -> Column:
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """Digest of a row's fields."""
    return F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256)


def fold(digest: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings beside it, level by level, add up to."""
    return F.aggregate(steps, digest, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]).cast("binary"), 256))


def siblings(steps: Column) -> Column:
    """The siblings' digests from the leaf's level to the root, one text."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


@dataclass
class Manifest:
    """Stored tables of a manifest.

    ``leaves``: group, id, digest, kept (the caller's columns), tree, n, rank. ``levels[l]``: the
    nodes of level l + 1 as (tree, n, lo, hi, digest, children), whose children are (lo, hi, digest)
    of level l in order; n is the number of leaves of the tree. ``trees``: group, tree, n, digest.
    ``above``: the manifest over the trees' roots; None there.
    """

    leaves: DataFrame
    levels: list[DataFrame]
    trees: DataFrame
    above: Manifest | None

    def root(self) -> str | None:
        """The digest that stands for everything; None for an empty table."""
        top = self.trees if self.above is None else self.above.trees
        found = top.select("digest").head()
        return found and found[0]


def manifest(
    docs: DataFrame, fields: Sequence[str], group: str = "source", order: str = "doc_id", keep: Sequence[str] | None = None
) -> Manifest:
    """The manifest of ``docs``; ``keep`` names the columns that go along with the leaves, ``order`` and ``group`` by default."""
    keep = [order, group] if keep is None else list(keep)
    rows = docs.select(
        F.col(group).alias("group"),
        F.col(order).alias("id"),
        leaf(*[F.col(c) for c in fields]).alias("digest"),
        F.struct(*keep).alias("kept"),
        F.monotonically_increasing_id().alias("row"),
    )
    return build(materialise(rows, "leaf-rows"), "leaves", True)


def ranked(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows``, a stored table, with ``rank``: the place of each in the whole order, from 0.

    Ranges of the order are sorted and numbered each in a task of its own, and then moved by what lies before.
    """
    ranges = max(1 + rows.count() // LEAVES_A_RANGE, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(int(ranges), *order).sortWithinPartitions(*order)
    # the number counts the rows of each partition from 0, with the partition in the upper bits
    dealt = materialise(dealt.withColumn("at", F.monotonically_increasing_id()), label)
    part = F.shiftright("at", 33)
    totals = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    joined = dealt.join(F.broadcast(bases), part == F.col("part"))
    return joined.withColumn("rank", F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "base", "at")


def build(rows: DataFrame, label: str, grouped: bool) -> Manifest:
    """The manifest over (group, id, digest, kept, row), a stored table; ``row`` only breaks ties."""
    rows = ranked(rows, ["group", "id", "digest", "row"], f"{label}-ranked").drop("row")
    # a tree is known by the place of its first leaf in the whole order
    trees = materialise(rows.groupBy("group").agg(F.min("rank").alias("tree"), F.count("*").alias("n")), f"{label}-trees")
    count, most = trees.agg(F.count("*"), F.max("n")).first()
    leaves = join_groups(rows, trees, ["group"], count, F.col("rank")).withColumn("rank", F.col("rank") - F.col("tree"))
    leaves = materialise(leaves, label)
    levels = _levels(leaves, most or 0, label)
    trees = materialise(trees.join(_roots(leaves, levels), "tree"), f"{label}-roots")
    above = None
    if grouped:
        heads = trees.select(F.lit(0).alias("group"), F.col("tree").alias("id"), "digest", F.struct("tree").alias("kept"), F.lit(0).alias("row"))
        above = build(heads, f"{label}-above", False)
    return Manifest(leaves, levels, trees, above)


def _levels(leaves: DataFrame, most: int, label: str) -> list[DataFrame]:
    """The nodes of every level over the leaves; ``most``: leaves of the largest tree."""
    below = _spans(leaves).select("tree", "n", "lo", "hi", "digest")
    levels: list[DataFrame] = []
    while FANOUT ** len(levels) < most:
        levels.append(materialise(_parents(below, len(levels) + 1), f"{label}-{len(levels) + 1}"))
        below = levels[-1]
    return levels


def _spans(leaves: DataFrame) -> DataFrame:
    """Leaves with the interval that each covers."""
    return leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1})


def _bucket(lo: str, level: int) -> Column:
    return F.expr(f"{lo} div {FANOUT**level}")


def _parents(below: DataFrame, level: int) -> DataFrame:
    """Nodes of ``level`` over those below: one for each bucket of FANOUT ** level ranks.

    A tree that has come down to one node is done and gives none.
    """
    runs = below.where(F.col("n") > FANOUT ** (level - 1)).groupBy("tree", _bucket("lo", level).alias("bucket"))
    runs = runs.agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
    digest = F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), "").cast("binary"), 256)
    return runs.select(
        "tree", "n", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"), digest.alias("digest"), "children"
    )


def _whole() -> Column:
    """Whether a node covers its whole tree."""
    return (F.col("lo") == 0) & (F.col("hi") == F.col("n"))


def _roots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, digest): the node of each tree that covers all its leaves."""
    found = _spans(leaves).where(_whole()).select("tree", "digest")
    for parents in levels:
        found = found.unionByName(parents.where(_whole()).select("tree", "digest"))
    return found


def _beside(children: str, lo: Column, hi: Column) -> Column:
    """What lies left and right of an interval among the children of its parent: the interval difference."""
    left = F.filter(children, lambda c: c["hi"] <= lo)
    right = F.filter(children, lambda c: c["lo"] >= hi)
    return F.struct(*[F.array_join(F.transform(x, lambda c: c["digest"]), "").alias(n) for x, n in ((left, "left"), (right, "right"))])


def _handed_down(below: DataFrame, above: DataFrame | None, level: int, trees: DataFrame) -> DataFrame:
    """Nodes or leaves ``below`` with subroot and steps: from their parents at ``level``, or from their tree if they are its root.

    A parent is found by the bucket of its level and holds the child's interval.
    """
    columns = [c for c in below.columns if c not in ("subroot", "steps")]
    roots = below.where(_whole()).join(trees.select(F.col("tree").alias("of"), "subroot", "steps"), F.col("tree") == F.col("of"))
    roots = roots.select(*columns, "subroot", "steps")
    if above is None:
        return roots
    p = above.select(*[F.col(c).alias(f"p_{c}") for c in ("tree", "lo", "hi", "children")], "subroot", "steps")
    inside = (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
    on = (F.col("tree") == F.col("p_tree")) & (_bucket("lo", level) == _bucket("p_lo", level)) & inside
    steps = F.concat(F.array(_beside("p_children", F.col("lo"), F.col("hi"))), "steps")
    return below.where(~_whole()).join(p, on).select(*columns, "subroot", steps.alias("steps")).unionByName(roots)


def _proved(m: Manifest) -> DataFrame:
    """The leaves of a manifest with subroot and steps."""
    if m.above is None:
        trees = m.trees.select("tree", F.col("digest").alias("subroot"), F.array().cast(STEPS).alias("steps"))
    else:
        upper = _proved(m.above).select(F.col("kept.tree").alias("tree"), "steps")
        trees = materialise(m.trees.select("tree", F.col("digest").alias("subroot")).join(upper, "tree"), "tree-proofs")
    above = None
    for level in range(len(m.levels), 0, -1):
        above = materialise(_handed_down(m.levels[level - 1].drop("digest"), above, level + 1, trees), f"proof-{level}")
    return _handed_down(_spans(m.leaves), above, 1, trees)


def prove(m: Manifest) -> DataFrame:
    """The kept columns of every leaf with leaf, subroot, root and steps: what lies beside it on every level up to the root.

    A result column takes the place of a kept one of its name.
    """
    kept = [f"kept.`{c}`" for c in m.leaves.schema["kept"].dataType.names if c.lower() not in RESULTS]
    return _proved(m).select(*kept, F.col("digest").alias("leaf"), "subroot", F.lit(m.root()).cast("string").alias("root"), "steps")


def nodes(m: Manifest) -> DataFrame:
    """All nodes within the groups' trees: (tree, level, lo, hi, digest), leaves at level 0."""
    found = _spans(m.leaves).select("tree", F.lit(0).alias("level"), "lo", "hi", "digest")
    for i, parents in enumerate(m.levels):
        found = found.unionByName(parents.select("tree", F.lit(i + 1).alias("level"), "lo", "hi", "digest"))
    return found
