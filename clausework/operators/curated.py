"""A hand-made model as a graph: entities, layers, concepts, releases and facts, then re-keyed by content-derived ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..schema import ENTITIES, RELATIONS, SpecConfig
from .merging import lifecycle

LAYER, BROADER, NEXT = "IN_LAYER", "BROADER", "NEXT_RELEASE"
#: Bits of an ``ord`` inside its kind of rows; kinds follow each other.
ORD_BITS = 40


def _behind(ord: Column, kind: int) -> Column:
    """``ord`` behind all rows of earlier kinds; one that does not fit is an error, never another's order."""
    number = ord.cast("long")
    return F.when(number.between(0, (1 << ORD_BITS) - 1), number + (kind << ORD_BITS)).otherwise(F.raise_error(F.concat(F.lit("no order for "), F.coalesce(ord.cast("string"), F.lit("null")))).cast("long"))


def _prov(cfg: SpecConfig, clause, anchor, curated: bool):
    return F.array(F.struct(F.lit(cfg.release).alias("release"), F.lit(cfg.spec).alias("spec"), F.lit(cfg.version).alias("version"), clause.alias("clause"), anchor.alias("anchor"), F.lit(curated or None).cast("boolean").alias("curated"), F.lit(None).cast("boolean").alias("external")))


def curated_graph(items: DataFrame, concepts: DataFrame, facts: DataFrame, releases: tuple[str, ...], layer: str, cfg: SpecConfig) -> tuple[DataFrame, DataFrame]:
    """(entities, relations) of items (ord, key, type, label, clause), concepts (ord, key, type, label, broader), and
    facts (ord, src, dst, type, modality, confidence, clause, procedure, attrs, quote) between their keys.

    Items with a clause are in the layer; each concept points to its broader one and each release to the next. Keys become
    ids in the end, so that the model can name things as it likes; a key that names nothing stays as it is.
    """
    spark = items.sparkSession
    none = F.lit(None).cast("string")
    rel = spark.createDataFrame([(i, r) for i, r in enumerate(releases)], "ord long, label string")
    e = items.select(_behind(F.col("ord"), 0).alias("ord"), "key", X.canonical_id(F.col("type"), F.col("label"), F.lit(cfg.spec)).alias("id"), "type", "label", _prov(cfg, F.col("clause"), F.col("label"), False).alias("defined_in"))
    c = concepts.select(_behind(F.col("ord"), 1).alias("ord"), "key", X.canonical_id(F.col("type"), F.col("label"), concept=F.col("key")).alias("id"), "type", "label", _prov(cfg, none, none, True).alias("defined_in"))
    r = rel.select(_behind(F.col("ord"), 2).alias("ord"), F.col("label").alias("key"), X.canonical_id(F.lit("Release"), F.col("label")).alias("id"), F.lit("Release").alias("type"), "label", _prov(cfg, none, none, True).alias("defined_in"))
    known = e.unionByName(c).unionByName(r)
    entities = known.select("ord", "id", "type", "label", F.lit("curated").alias("extractor"), none.alias("confidence"), none.alias("review"), "defined_in", *lifecycle(cfg.release))

    def edge(rows, ord, id, kind, src, dst, clause=none, quote=none, modality=F.lit("curated"), confidence=F.lit("high"), ctx=none, attrs=None):
        attrs = F.create_map().cast("map<string,string>") if attrs is None else attrs
        return rows.select(ord.cast("long").alias("ord"), id.alias("id"), kind.alias("type"), src.alias("src"), dst.alias("dst"), modality.alias("modality"), confidence.alias("confidence"), ctx.alias("procedure_ctx"), attrs.alias("attrs"), F.lit("curated").alias("extractor"), _prov(cfg, clause, quote, True).alias("provenance"), *lifecycle(cfg.release))

    o, k = F.col("ord"), F.col("key")
    edges = edge(facts, _behind(o, 0), F.concat(F.lit("r"), o), F.col("type"), F.col("src"), F.col("dst"), F.col("clause"), F.col("quote"), F.col("modality"), F.col("confidence"), F.col("procedure"), X.attributes(F.col("attrs")))
    edges = edges.unionByName(edge(items.where("clause is not null"), _behind(o, 1), F.concat(F.lit("il_"), k), F.lit(LAYER), k, F.lit(layer)))
    edges = edges.unionByName(edge(concepts.where("broader is not null"), _behind(o, 2), F.concat(F.lit("br_"), k), F.lit(BROADER), k, F.col("broader")))
    following = rel.withColumn("next", F.lead("label").over(W.orderBy("ord"))).where("next is not null")
    edges = edges.unionByName(edge(following, _behind(o, 3), F.concat(F.lit("nx_"), "label"), F.lit(NEXT), F.col("label"), F.col("next")))
    ids = known.select("key", F.col("id").alias("to"))
    for end in ("src", "dst"):
        edges = edges.join(ids.withColumnRenamed("key", end), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    names = lambda ddl: [f.split()[0] for f in ddl.split(", ")]
    return entities.select(*names(ENTITIES)), edges.select(*names(RELATIONS))


def concept_scheme(concepts: DataFrame, depths: DataFrame) -> DataFrame:
    """concepts with their depth below the root."""
    return concepts.join(depths.withColumnRenamed("node", "key"), "key", "left")
