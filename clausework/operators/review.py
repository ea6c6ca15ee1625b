"""What people should look at: conflicts, weak types, weak relations, warnings, aliases; and alias suggestions themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..provider import vectors_of
from ..schema import FUNCTIONAL
from ..storage import checkpointed
from .nearest import nearest_labels, nearest_vectors

#: Edges of the histogram of distances, and the upper bounds of the coarse one.
EDGES = (0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 0.9, 1.01)
COARSE = (0.05, 0.1, 0.18, 0.25, 0.35, 0.5, 1.01)


def conflict_groups(relations: DataFrame, functional: tuple[str, ...] = FUNCTIONAL) -> DataFrame:
    """(src, type, n_objects, members): one subject, one functional relation, several objects; members in order."""
    p = F.get("provenance", F.lit(0))
    member = F.struct("ord", "id", "dst", "confidence", "extractor", p["anchor"].alias("anchor"), p["clause"].alias("clause"))
    groups = relations.where(F.col("type").isin(*functional)).groupBy("src", "type")
    return groups.agg(F.countDistinct("dst").alias("n_objects"), F.array_sort(F.collect_list(member)).alias("members")).where("n_objects >= 2")


def review_queue(entities: DataFrame, relations: DataFrame, warned: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(section, pos, sub, kind, id, type, src, reason, detail, distance), in order of section, pos, sub, src, type: conflict
    groups (by src and type alone), entities and relations of low or medium confidence, warnings, alias merges."""
    none, weak = F.lit(None).cast("string"), F.col("confidence").isin("low", "med")
    first = lambda c: F.get(c, F.lit(0))

    def item(rows: DataFrame, section: int, pos: Column, kind: str, **v: Column) -> DataFrame:
        fields = [v.get(c, none).cast("string").alias(c) for c in ("id", "type", "src", "reason", "detail")]
        return rows.select(F.lit(section).alias("section"), pos.cast("long").alias("pos"), v.get("sub", F.lit(0)).cast("int").alias("sub"), F.lit(kind).alias("kind"), *fields, v.get("distance", F.lit(None)).cast("double").alias("distance"))

    groups = conflict_groups(relations)
    queue = item(groups, 0, F.lit(0), "conflict-group", type=F.col("type"), src=F.col("src"), detail=F.array_join(F.transform("members", lambda m: m["dst"]), ","))
    queue = queue.unionByName(item(entities.where(weak), 1, F.col("ord"), "ambiguous-entity-type", id=F.col("id"), type=F.col("type"), reason=F.col("review"), detail=first("defined_in")["clause"]))
    queue = queue.unionByName(item(relations.where(weak), 2, F.col("ord"), "low-confidence-relation", id=F.col("id"), type=F.col("type"), src=F.col("src"), detail=first("provenance")["anchor"]))
    queue = queue.unionByName(item(warned, 3, F.col("row_ord"), "validation-warning", sub=F.col("pos"), id=F.col("id"), reason=F.col("cat"), detail=F.col("clause")))
    if aliases is not None:
        merges = aliases.where("proposal = 'merge'")
        queue = queue.unionByName(item(merges, 4, F.col("surface_ord"), "alias-suggestion", id=F.col("surface_id"), src=F.col("canonical_id"), reason=F.col("backend"), distance=F.col("distance")))
    return queue


def proposals(found: DataFrame, rho: float, backend: str) -> DataFrame:
    """found with the rounded distance and what it proposes at rho (which is decided on the exact one)."""
    return found.withColumns({"distance": F.bround("exact", 4), "backend": F.lit(backend), "proposal": F.when(F.col("exact") < rho, "merge").otherwise("new-entity")})


def aligned(entities: DataFrame, compatible: DataFrame, rho: float, embed: Callable[[list[str]], list[list[float]]] | None = None, size: int = 32) -> DataFrame:
    """Suggestions by the vectors of a source, or by labels where there is none or it fails for good; rows name their backend."""
    vectors = None
    if embed is not None:
        try:
            vectors = checkpointed(vectors_of(entities, embed, size))
        except Exception as e:  # a task's error reaches the driver inside Spark's own
            if "EngineError" not in str(e):
                raise
    return suggest_aliases(entities, compatible, rho, vectors)


def suggest_aliases(entities: DataFrame, compatible: DataFrame, rho: float, vectors: DataFrame | None = None) -> DataFrame:
    """Suggestions for model-made entities whose id no deterministic one has: by vectors (label, vector) if given, else by labels."""
    canonical = entities.where(F.startswith(F.coalesce("extractor", F.lit("")), F.lit("deterministic")))
    surfaces = entities.where("extractor = 'llm'").join(canonical.select("id"), "id", "left_anti")
    if vectors is None:
        return proposals(nearest_labels(surfaces, canonical, compatible), rho, "difflib")
    of = lambda e: e.join(vectors, "label")
    return proposals(nearest_vectors(of(surfaces), of(canonical), compatible), rho, "embedding")


def distance_histogram(suggestions: DataFrame, edges: tuple[float, ...] = EDGES, overflow: bool = False) -> DataFrame:
    """(lo, hi, n, cumulative) for left-closed bins; distances beyond the last edge are in none, or in an overflow bin."""
    bounds = [(float(a), float(b)) for a, b in zip(edges, edges[1:], strict=False)] + ([(float(edges[-1]), float("inf"))] if overflow else [])
    bins = suggestions.sparkSession.createDataFrame(bounds, "lo double, hi double")
    lo = F.lit(None).cast("double")
    for a, b in bounds:
        lo = F.when((F.col("distance") >= a) & (F.col("distance") < b), F.lit(a)).otherwise(lo)
    counts = suggestions.select(lo.alias("lo")).where("lo is not null").groupBy("lo").agg(F.count(F.lit(1)).alias("n"))
    joined = bins.join(counts, "lo", "left")
    return joined.select("lo", "hi", F.coalesce("n", F.lit(0)).alias("n")).withColumn("cumulative", F.sum("n").over(W.orderBy("lo").rowsBetween(W.unboundedPreceding, W.currentRow)))


def coarse_histogram(suggestions: DataFrame, bounds: tuple[float, ...] = COARSE) -> DataFrame:
    """(bucket, n): the first upper bound above the distance."""
    bucket = F.lit(None).cast("string")
    for b in reversed(bounds):
        bucket = F.when(F.col("distance") < b, F.lit(f"<{b:.2f}")).otherwise(bucket)
    return suggestions.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def boundary(suggestions: DataFrame, rho: float, samples: int = 8) -> DataFrame:
    """Suggestions next to rho: the last ``samples`` below and the first at or above, with side and place (1 is next to rho)."""
    side = F.when(F.col("distance") < rho, "below").otherwise("above")
    rows = suggestions.withColumn("side", side)
    key = F.when(F.col("side") == "below", -F.col("distance")).otherwise(F.col("distance"))
    tie = F.when(F.col("side") == "below", -F.col("surface_ord")).otherwise(F.col("surface_ord"))
    best = [rows.where(F.col("side") == s).orderBy(key, tie).limit(samples) for s in ("below", "above")]
    both = best[0].unionByName(best[1])
    return both.withColumn("place", F.row_number().over(W.partitionBy("side").orderBy(key, tie)))
