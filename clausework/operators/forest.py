"""Trees by pointer doubling: ancestors, depths and interval numbers in a number of rounds that is logarithmic in their depth.

Every node has one parent or none. ``jumps`` gives each node's ancestor 1, 2, 4, ... steps up; everything else is made from
those tables, each written down, so that plans do not grow. Nodes on a cycle, or below one, have no topmost ancestor;
``jumps`` sets them aside.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import checkpointed, maybe_broadcast

#: Siblings are numbered in so many buckets, that no task holds all children of a node.
BUCKETS = 256


@dataclass
class Jumps:
    """nodes (node); levels[k] (node, up): the ancestor 2^k steps up, and how many rows that has; astray (node): into a cycle."""

    nodes: DataFrame
    levels: list[tuple[DataFrame, int]]
    astray: DataFrame | None

    def up(self, k: int) -> DataFrame:
        """levels[k], broadcast if its counted size allows."""
        return maybe_broadcast(self.levels[k][0], self.levels[k][1], 96)


def single_parents(links: DataFrame) -> bool:
    """Whether no node has two parents."""
    return not links.where("parent is not null and node <> parent").groupBy("node").agg(F.min("parent").alias("a"), F.max("parent").alias("b")).where("a <> b").limit(1).count()


def jumps(links: DataFrame) -> Jumps:
    """The jumps of links (node, parent); a parent that is no node itself is a topmost one."""
    rows = checkpointed(links.select("node", "parent").where("node is not null").distinct())
    step = checkpointed(rows.where("parent is not null and node <> parent").select("node", F.col("parent").alias("up")).distinct())
    nodes = rows.select("node").distinct()
    n = step.count()
    levels, astray = [(step, n)], None
    while levels[-1][1]:
        if 1 << (len(levels) - 1) > n:  # further than there are links: only cycles go on
            astray = levels[-1][0].select("node")
            levels = [(checkpointed(x.join(astray, "node", "left_anti")), c) for x, c in levels[:-1]]
            break
        last, rows_ = levels[-1]
        ahead = maybe_broadcast(last.select(F.col("node").alias("up"), F.col("up").alias("further")), rows_, 96)
        nxt = checkpointed(last.join(ahead, "up").select("node", F.col("further").alias("up")))
        levels.append((nxt, nxt.count()))
    return Jumps(nodes, [x for x in levels if x[1]], astray)


def all_ancestors(j: Jumps, start: DataFrame) -> DataFrame:
    """(node, ancestor, depth) of the start nodes (node): themselves at depth 0, and each ancestor once, from the longest jumps down."""
    pairs = start.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth"))
    for k in reversed(range(len(j.levels))):
        ahead = j.up(k).select(F.col("node").alias("ancestor"), "up")
        more = pairs.join(ahead, "ancestor").select("node", F.col("up").alias("ancestor"), (F.col("depth") + (1 << k)).alias("depth"))
        pairs = checkpointed(pairs.unionByName(more))
    return pairs


def roots(j: Jumps, nodes: DataFrame) -> DataFrame:
    """(node, root, depth): the topmost ancestor, and the steps to it; one row for each node in every round."""
    found = nodes.select("node", F.col("node").alias("root"), F.lit(0).alias("depth"))
    for k in reversed(range(len(j.levels))):
        ahead = j.up(k).select(F.col("node").alias("root"), "up")
        found = found.join(ahead, "root", "left").select("node", F.coalesce("up", "root").alias("root"), (F.col("depth") + F.when(F.col("up").isNotNull(), 1 << k).otherwise(0)).alias("depth"))
        found = checkpointed(found) if k % 4 == 0 else found
    return found


def marked(j: Jumps, start: DataFrame) -> DataFrame:
    """(node): the start nodes and all their ancestors, without any pair of both."""
    found = start.select("node").distinct()
    for k in range(len(j.levels)):  # after a round, all ancestors of less than 2^(k + 1) steps
        found = checkpointed(found.unionByName(found.join(j.up(k), "node").select(F.col("up").alias("node"))).distinct())
    return found


def intervals(links: DataFrame) -> DataFrame:
    """(node, root, depth, pre, post) of a forest: u is an ancestor of v, or v itself, exactly if u.pre <= v.pre <= u.post.

    Subtree sizes are summed over doubling distances; a node's number is the sum, along its way down from the root, of the
    sizes of earlier siblings and one for each step. Nodes are numbered from 0; a parent that is no node is one here.
    """
    parents = links.where("parent is not null").select(F.col("parent").alias("node"), F.lit(None).cast(links.schema["parent"].dataType).alias("parent"))
    listed = links.select("node", "parent")
    links = listed.unionByName(parents.join(listed.select("node").distinct(), "node", "left_anti"))
    j = jumps(links)
    if j.astray is not None:
        raise ValueError("links with a cycle have no intervals")
    size = j.nodes.select("node", F.lit(1).cast("long").alias("size"))
    for k in range(len(j.levels)):  # descendants of less than 2^k steps, then those of less than 2^(k + 1)
        more = size.join(j.levels[k][0], "node").groupBy(F.col("up").alias("node")).agg(F.sum("size").alias("more"))
        size = checkpointed(size.join(more, "node", "left").select("node", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
    step = j.levels[0][0] if j.levels else size.select("node", F.lit(None).cast(links.schema["parent"].dataType).alias("up")).limit(0)
    sized = checkpointed(size.join(step, "node", "left").withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(BUCKETS))))
    ahead = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    whole = sized.groupBy(F.col("up").alias("above"), F.col("bucket").alias("part")).agg(F.sum("size").alias("all"))
    whole = whole.select("above", "part", F.coalesce(F.sum("all").over(ahead(W.partitionBy("above").orderBy("part"))), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("size").over(ahead(W.partitionBy("up", "bucket").orderBy("node"))), F.lit(0))
    placed = sized.withColumn("inside", inside).join(whole, F.col("up").eqNullSafe(F.col("above")) & (F.col("bucket") == F.col("part")))
    way = placed.select("node", F.col("up").alias("at"), (F.col("before") + F.col("inside")).alias("pre"), "size")
    way = checkpointed(way.withColumn("pre", F.col("pre") + F.when(F.col("at").isNotNull(), 1).otherwise(0)))
    for _ in range(len(j.levels)):  # sums over 2^k steps, from each node up
        ahead_of = way.select(F.col("node").alias("at"), F.col("at").alias("further"), F.col("pre").alias("more"))
        way = checkpointed(way.join(ahead_of, "at", "left").select("node", F.col("further").alias("at"), (F.col("pre") + F.coalesce("more", F.lit(0))).alias("pre"), "size"))
    return roots(j, j.nodes).join(way.select("node", "pre", (F.col("pre") + F.col("size") - 1).alias("post")), "node")
