"""Records by content-derived identity: building, first-wins merging, and facts to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..schema import SpecConfig


def first_by(rows: DataFrame, keys: list[str], *order: Column | str, last: bool = False) -> DataFrame:
    """One row for each key: the first (or last) in order; an aggregation, so a frequent key combines before its shuffle."""
    by = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    pick = F.max_by if last else F.min_by
    return rows.groupBy(*keys).agg(pick(F.struct(*rows.columns), by).alias("row_")).select("row_.*")


#: Bits of the parts of an ``ord`` made of three: 8 sources, clauses and places.
PLACE_BITS, CLAUSE_BITS = 20, 40


def ordinal(source: Column, clause: Column, place: Column) -> Column:
    """One number that orders by source, clause, place; a part that does not fit is an error, never another's order."""
    fits = (source.cast("long") < 8) & clause.cast("long").between(0, (1 << CLAUSE_BITS) - 1) & place.cast("long").between(0, (1 << PLACE_BITS) - 1)
    number = (source.cast("long") * (1 << CLAUSE_BITS) + clause.cast("long")) * (1 << PLACE_BITS) + place.cast("long")
    return F.when(fits, number).otherwise(F.raise_error(F.concat_ws(" ", F.lit("no order for"), source.cast("string"), clause.cast("string"), place.cast("string"))).cast("long"))


def provenance(cfg: SpecConfig, clause: Column, anchor: Column) -> Column:
    none = F.lit(None).cast("boolean")
    return F.array(F.struct(F.lit(cfg.release).alias("release"), F.lit(cfg.spec).alias("spec"), F.lit(cfg.version).alias("version"), clause.alias("clause"), anchor.alias("anchor"), none.alias("curated"), none.alias("external")))


def lifecycle(release: str, agnostic: bool = False) -> list[Column]:
    none = F.lit(None).cast("string")
    observed = F.array().cast("array<string>") if agnostic else F.array(F.lit(release))
    return [observed.alias("observed_in"), (none if agnostic else F.lit(release)).alias("introduced_in"), none.alias("valid_until"), none.alias("supersedes")]


def entity_records(rows: DataFrame, cfg: SpecConfig) -> DataFrame:
    """Entities of rows (ord, type, label, clause, anchor, extractor, confidence, review)."""
    return rows.select("ord", X.canonical_id(F.col("type"), F.col("label"), F.lit(cfg.spec)).alias("id"), "type", "label", "extractor", "confidence", "review", provenance(cfg, F.col("clause"), F.col("anchor")).alias("defined_in"), *lifecycle(cfg.release))


def relation_records(rows: DataFrame, cfg: SpecConfig) -> DataFrame:
    """Relations of rows (ord, type, src, dst, clause, anchor, modality, confidence, procedure_ctx, extractor)."""
    modality, confidence = F.coalesce("modality", F.lit("deterministic")), F.coalesce("confidence", F.lit("high"))
    attrs = F.create_map().cast("map<string,string>")
    return rows.select("ord", X.relation_id(F.col("type"), F.col("src"), F.col("dst")).alias("id"), "type", "src", "dst", modality.alias("modality"), confidence.alias("confidence"), "procedure_ctx", attrs.alias("attrs"), "extractor", provenance(cfg, F.col("clause"), F.col("anchor")).alias("provenance"), *lifecycle(cfg.release))


def anchored(records: DataFrame, lineage: str, order: Column | str = "ord") -> DataFrame:
    """(id, k, o, row, lineage): for each id, clause and anchor, the first record that has them, and its items of these with their places.

    k is null for records without items, row is what else a record has. A batch or a streaming aggregation: an id that many
    records name combines before its shuffle.
    """
    placed = F.transform(lineage, lambda p, i: F.struct(i.alias("pos"), p.alias("item")))
    keys = F.array_distinct(F.transform(lineage, lambda p: F.struct(p["clause"].alias("clause"), p["anchor"].alias("anchor"))))
    rest = F.struct(*(c for c in records.columns if c not in ("id", "ord", "batch", lineage)))
    rows = records.select("id", (F.col(order) if isinstance(order, str) else order).alias("o"), rest.alias("row"), placed.alias("all"), F.explode_outer(keys).alias("k"))
    same = lambda x: x["item"]["clause"].eqNullSafe(F.col("k.clause")) & x["item"]["anchor"].eqNullSafe(F.col("k.anchor"))
    mine = F.when(F.col("k").isNotNull(), F.filter("all", same))
    rows = rows.select("id", "k", F.struct("o", "row", mine.alias(lineage)).alias("v"))
    return rows.groupBy("id", "k").agg(F.min_by("v", F.struct("v.o")).alias("v")).select("id", "k", "v.*")


def gathered(parts: DataFrame, lineage: str) -> DataFrame:
    """(id, ord, what else a record has, lineage): one record for each id of ``anchored`` parts."""
    whole = parts.groupBy("id").agg(F.min_by("row", F.struct("o")).alias("row"), F.collect_list(F.struct("o", F.col(lineage).alias("l"))).alias("all"))
    none = F.array().cast(parts.schema[lineage].dataType)
    placed = F.transform("all", lambda x: F.transform(F.coalesce(x["l"], none), lambda y: F.struct(x["o"].alias("o"), y["pos"].alias("pos"), y["item"].alias("item"))))
    return whole.select("id", F.array_min("all.o").alias("ord"), "row.*", F.array_sort(F.flatten(placed))["item"].alias(lineage))


def merge_records(records: DataFrame, lineage: str) -> DataFrame:
    """One record for each id: the first in ``ord`` with the provenance of all, in order.

    A later record adds those of its items whose clause and anchor no record before it has; items that repeat inside one
    record stay. Records are shuffled twice: by id, clause and anchor, where the first one wins, and what is left by id.
    """
    return gathered(anchored(records, lineage), lineage).select(*records.columns)


def facts_to_records(facts: DataFrame, cfg: SpecConfig) -> tuple[DataFrame, DataFrame]:
    """(entities, relations) of facts (clause_ord, clause, pos, and the fact's fields), clause by clause.

    Of one clause's entities with an id the last fact's holds, of its relations the first. Anchors belong to the clause.
    """
    ends = F.array(F.struct(F.lit(0).alias("end"), F.col("subject_type").alias("type"), F.col("subject").alias("label")), F.struct(F.lit(1).alias("end"), F.col("object_type").alias("type"), F.col("object").alias("label")))
    none = F.lit(None).cast("string")
    rows = facts.select("clause_ord", "clause", "pos", "anchor", F.inline(ends))
    rows = rows.select(ordinal(F.lit(0), F.col("clause_ord"), F.col("pos") * 2 + F.col("end")).alias("ord"), "clause", "type", "label", "anchor", F.lit("llm").alias("extractor"), none.alias("confidence"), none.alias("review"))
    entities = entity_records(rows, cfg).withColumn("clause_", F.get("defined_in", F.lit(0))["clause"])
    entities = first_by(entities, ["clause_", "id"], "ord", last=True).drop("clause_")
    of = lambda end: X.canonical_id(F.col(f"{end}_type"), F.col(end), F.lit(cfg.spec))
    edges = facts.select(ordinal(F.lit(0), F.col("clause_ord"), F.col("pos")).alias("ord"), F.col("rel").alias("type"), of("subject").alias("src"), of("object").alias("dst"), "clause", "anchor", F.coalesce("modality", F.lit("prose")).alias("modality"), F.coalesce("confidence", F.lit("low")).alias("confidence"), F.lit("llm").alias("procedure_ctx"), F.lit("llm").alias("extractor"))
    relations = relation_records(edges, cfg).withColumn("clause_", F.get("provenance", F.lit(0))["clause"])
    return entities, first_by(relations, ["clause_", "id"], "ord").drop("clause_")
