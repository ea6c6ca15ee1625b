"""Closures over parent links, and views of a graph."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..storage import checkpointed
from . import forest


def _by_levels(links: DataFrame, start: DataFrame) -> DataFrame:
    """(node, ancestor, depth) where nodes have several parents or stand below a cycle: one join per level, from the start nodes up."""
    step = links.where("parent is not null").select(F.col("node").alias("at"), F.col("parent").alias("up"))
    level = start.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth"), F.array("node").alias("path"))
    done = level
    for depth in count(1):  # a path repeats no node, so a level is empty at last
        level = level.join(step, F.col("ancestor") == F.col("at")).where(~F.array_contains("path", F.col("up")))
        level = checkpointed(level.select("node", F.col("up").alias("ancestor"), F.lit(depth).alias("depth"), F.concat("path", F.array("up")).alias("path")))
        if not level.limit(1).count():
            break
        done = done.unionByName(level)
    return done.groupBy("node", "ancestor").agg(F.min("depth").alias("depth"))


def ancestors(links: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """(node, ancestor, depth) for links (node, parent): every node itself at depth 0, then upwards; cycles end where they close.

    With ``start`` (node) only the ancestors of those nodes are followed. Trees take a number of rounds that is logarithmic
    in their depth (``forest``); only nodes that have several parents, or stand below a cycle, are followed level by level.
    """
    links = checkpointed(links.select("node", "parent").where("node is not null").distinct())
    nodes = links.select("node").distinct()
    nodes = nodes if start is None else nodes.join(start.select("node").distinct(), "node", "left_semi")
    if not forest.single_parents(links):
        return _by_levels(links, nodes)
    j = forest.jumps(links)
    if j.astray is None:
        return forest.all_ancestors(j, nodes)
    return forest.all_ancestors(j, nodes.join(j.astray, "node", "left_anti")).unionByName(_by_levels(links, nodes.join(j.astray, "node", "left_semi")))


def depths(links: DataFrame) -> DataFrame:
    """(node, depth): steps to the topmost ancestor."""
    links = checkpointed(links.select("node", "parent").where("node is not null").distinct())
    if forest.single_parents(links):
        j = forest.jumps(links)
        if j.astray is None:
            return forest.roots(j, j.nodes).select("node", "depth")
    return ancestors(links).groupBy("node").agg(F.max("depth").alias("depth"))


def spine(clauses: DataFrame, referenced: DataFrame) -> DataFrame:
    """(key, parent) of referenced clauses and all their ancestors; parent only if it is in the spine."""
    links = checkpointed(clauses.select(F.col("key").alias("node"), "parent").where("node is not null").distinct())
    known = links.select("node").distinct()
    start = referenced.select(F.col("key").alias("node")).distinct().join(known, "node", "left_semi")
    keys = None
    if forest.single_parents(links):
        j = forest.jumps(links)
        keys = forest.marked(j, start) if j.astray is None else None
    if keys is None:
        keys = ancestors(links, start).select(F.col("ancestor").alias("node")).distinct()
    keys = checkpointed(keys.join(known, "node", "left_semi").select(F.col("node").alias("key")))
    held = clauses.select("key", "parent").join(keys, "key", "left_semi")
    parents = keys.select(F.col("key").alias("p"))
    return held.join(parents, F.col("parent") == F.col("p"), "left").select("key", F.col("p").alias("parent"))


def picked(provenance: Column, release: str) -> Column:
    """The provenance to show: of the release with a clause, else the first with a clause, else the first."""
    with_clause = F.filter(provenance, lambda p: p["clause"].isNotNull())
    return F.coalesce(F.get(F.filter(with_clause, lambda p: p["release"] == release), F.lit(0)), F.get(with_clause, F.lit(0)), F.get(provenance, F.lit(0)))


def provenance_text(provenance: Column, release: str) -> Column:
    p = picked(provenance, release)
    return F.when(p.isNull(), "curated").otherwise(F.concat_ws(" ", p["spec"], p["release"], F.concat(F.lit("clause "), p["clause"])))


def view_nodes(entities: DataFrame, clauses: DataFrame, release: str) -> DataFrame:
    """(id, label, grp, detail): entities, and the clauses of their spine."""
    p = picked(F.col("defined_in"), release)
    shown = entities.select("id", "label", F.col("type").alias("grp"), provenance_text(F.col("defined_in"), release).alias("detail"))
    refs = entities.select(p["clause"].alias("key")).where("key is not null")
    tree = spine(clauses, refs).select("key").join(clauses.select("key", "number", "title"), "key")
    return shown.unionByName(tree.select(F.concat(F.lit("clause:"), "key").alias("id"), F.coalesce("number", "key").alias("label"), F.lit("Clause").alias("grp"), F.col("title").alias("detail")))


def view_edges(entities: DataFrame, relations: DataFrame, clauses: DataFrame, release: str) -> DataFrame:
    """(id, src, dst, label): relations, the tree inside the spine, and entities' definitions in it."""
    clause = picked(F.col("defined_in"), release)["clause"]
    refs = entities.select("id", clause.alias("key")).where("key is not null")
    tree = spine(clauses, refs)
    at = lambda c: F.concat(F.lit("clause:"), c)
    contains = tree.where("parent is not null").select(F.concat(F.lit("ct:"), "key").alias("id"), at(F.col("parent")).alias("src"), at(F.col("key")).alias("dst"), F.lit("CONTAINS").alias("label"))
    defined = refs.join(tree.select("key"), "key").select(F.concat(F.lit("di:"), "id").alias("id"), F.col("id").alias("src"), at(F.col("key")).alias("dst"), F.lit("DEFINED_IN").alias("label"))
    return relations.select("id", "src", "dst", F.col("type").alias("label")).unionByName(contains).unionByName(defined)


def focused(nodes: DataFrame, edges: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Edges that ``keep`` selects and the nodes at their ends."""
    shown = edges.where(keep)
    ends = shown.select(F.col("src").alias("id")).union(shown.select("dst")).distinct()
    return nodes.join(ends, "id", "left_semi"), shown


def new_since(rows: DataFrame, seen: DataFrame) -> DataFrame:
    return rows.join(seen.select("id").distinct(), "id", "left_anti")


def counts_by(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def highlights(facts: DataFrame, clauses: DataFrame) -> DataFrame:
    """(key, pos, start, length): where each fact's anchor stands in its clause (from 1), by ``functions.text.located``; those
    that start inside an earlier one go.

    Of facts that start at one place the first holds, by aggregation, so what is gathered of a clause is bounded by its text.
    """
    found = facts.join(clauses.select("key", "text"), "key").select("key", "pos", X.located(F.col("anchor"), F.col("text")).alias("at")).where("at is not null")
    first = found.groupBy("key", "at.start").agg(F.min(F.struct("pos", "at.length")).alias("m"))
    kind = f"struct<start:int,pos:{facts.schema['pos'].dataType.simpleString()},length:int>"
    spans = first.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "m.pos", "m.length").cast(kind))).alias("s"))
    zero = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{kind}>").alias("kept"))
    step = lambda a, x: F.when(x["start"] > a["end"], F.struct((x["start"] + x["length"] - 1).alias("end"), F.concat(a["kept"], F.array(x)).alias("kept"))).otherwise(a)
    return spans.select("key", F.explode(F.aggregate("s", zero, step)["kept"]).alias("k")).select("key", "k.pos", "k.start", "k.length")


def layer_counts(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(concept, entities): how many entities are in each layer."""
    return relations.where("type = 'IN_LAYER'").join(entities.select(F.col("id").alias("src")), "src", "left_semi").groupBy(F.col("dst").alias("concept")).agg(F.countDistinct("src").alias("entities"))

