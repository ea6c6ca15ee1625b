"""Risks of a graph that it alone can show, as one table of checks with a gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: Checks and whether one hit closes the gate.
CHECKS = (("R1", "facts outside the schema or without their anchor", True), ("R2", "labels that differ in case or separators alone", False), ("R3", "removals without a mark", True), ("R4", "values that hold for one release between equal ones", False), ("R5", "facts from prose", False), ("R6", "introductions at the earliest release", False), ("R7", "anchors that the corpus does not bear out", True))


def near_duplicates(entities: DataFrame) -> DataFrame:
    """(type, norm, ids): entities of one type whose normalised labels agree."""
    return entities.groupBy("type", X.norm_label(F.col("label")).alias("norm")).agg(F.sort_array(F.collect_set("id")).alias("ids")).where(F.size("ids") > 1)


def blips(segments: DataFrame) -> DataFrame:
    """Segments of one observation whose neighbours on both sides have one value."""
    from pyspark.sql import Window as W

    w = W.partitionBy("key").orderBy("segment")
    around = segments.withColumns({"before": F.lag("value").over(w), "after": F.lead("value").over(w)})
    return around.where((F.col("observations") == 1) & (F.col("before") == F.col("after"))).drop("before", "after")


def audit(entities: DataFrame, relations: DataFrame, findings: DataFrame, warnings: DataFrame, presence: DataFrame, segments: DataFrame, marked: DataFrame) -> DataFrame:
    """(risk, what, hits, gate, passed) for R1 to R7; marked (key) are removals that a document states."""
    hits = (
        findings.select("id"), near_duplicates(entities).select("norm"), presence.where("valid_until is not null").join(marked, "key", "left_anti").select("key"),
        blips(segments).select("key"), relations.where("modality = 'prose'").select("id"), presence.where("floor").select("key"), warnings.where("cat = 'anchor-missing'").select("id"),
    )
    out = None
    for (risk, what, gate), rows in zip(CHECKS, hits, strict=True):
        n = rows.agg(F.count(F.lit(1)).alias("hits")).select(F.lit(risk).alias("risk"), F.lit(what).alias("what"), "hits", F.lit(gate).alias("gate"))
        out = n if out is None else out.unionByName(n)
    return out.withColumn("passed", ~F.col("gate") | (F.col("hits") == 0))
