"""Deterministic extraction: procedures from titles and headings above them, vocabulary, and cross-references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..schema import SpecConfig
from ..storage import checkpointed
from .automaton import terms_in
from .graphs import ancestors
from .merging import entity_records, first_by, merge_records, ordinal, relation_records

#: Titles that name no procedure, levels at which procedures stand, titles to review, and references to clauses.
GENERIC_TITLES = ("general", "void", "introduction", "scope", "", "purpose")
PROCEDURE_LEVELS = (3, 4, 5)
AMBIGUOUS_TITLE = r"(?i)(\bparameters?\b|as a security mechanism|[-–]\s*general$|\babnormal cases\b|\bstored information\b|\bintroduction\b)"
CROSS_REFERENCE = r"(?:as )?(?:specified|described|defined) in (?:(?:sub)?clause\s+)?(\d+(?:\.\d+)+[A-Z]?)"


def _titled(clauses: DataFrame) -> DataFrame:
    title = X.strip(F.coalesce("title", F.lit("")))
    review = F.rlike(title, F.lit(AMBIGUOUS_TITLE))
    rows = clauses.withColumn("label", title).where(~F.lower("label").isin(*GENERIC_TITLES) & F.col("level").isin(*PROCEDURE_LEVELS))
    return rows.withColumns({"confidence": F.when(review, "med").otherwise("high"), "review": F.when(review, "ambiguous-procedure-title"), "at": F.coalesce("number", "key")})


def procedures(clauses: DataFrame, kept: DataFrame) -> DataFrame:
    """(prio, o, at, type, label, clause, anchor, extractor, confidence, review): kept clauses with a procedure's title, and
    headings above kept clauses that are none of those, nearest first."""
    units = kept.where(~F.contains("key", F.lit("/")))
    own = _titled(units).where(X.strip(F.coalesce("text", F.lit(""))) != "")
    shape = lambda df, prio, o, how: df.select(F.lit(prio).alias("prio"), o.alias("o"), "at", F.lit("Procedure").alias("type"), "label", F.col("key").alias("clause"), F.col("label").alias("anchor"), F.lit(f"deterministic:{how}").alias("extractor"), "confidence", "review")
    direct = shape(own, 0, F.struct(F.col("ord").cast("long").alias("ord"), F.lit(0).alias("depth")), "procedure")
    up = ancestors(clauses.select(F.col("key").alias("node"), "parent"), units.select(F.col("key").alias("node"))).where("depth > 0")
    up = up.join(units.select(F.col("key").alias("node"), F.col("ord").alias("from_ord")), "node").select(F.col("ancestor").alias("key"), F.struct(F.col("from_ord").cast("long").alias("ord"), F.col("depth")).alias("o"))
    nearest = up.groupBy("key").agg(F.min("o").alias("o"))
    above = _titled(clauses).join(nearest, "key").join(direct.select("at").distinct(), "at", "left_anti")
    above = first_by(above, ["at"], F.col("o"))
    return direct.unionByName(shape(above, 1, F.col("o"), "procedure-heading"))


def vocabulary(spark: SparkSession, cfg: SpecConfig) -> DataFrame:
    """(n, type, term): the vocabulary of a specification as a table, in its order."""
    rows = [(i, t, term) for i, (t, term) in enumerate((t, term) for t, terms in cfg.vocab for term in terms)]
    return spark.createDataFrame(rows, "n int, type string, term string")


def vocabulary_hits(clauses: DataFrame, cfg: SpecConfig | None = None, key: str = "key", text: str = "text", terms: DataFrame | None = None) -> DataFrame:
    """(key, ord, type, term, n): terms that stand in a clause's text as whole words, n in order of the vocabulary.

    Terms are those of the specification, or a table (n, type, term) of any size: one machine finds all of them in one pass.
    """
    terms = vocabulary(clauses.sparkSession, cfg) if terms is None else terms.select("n", "type", "term")
    rows = clauses.select(F.col(key).alias("key"), "ord", F.col(text).alias("text_"))
    return terms_in(rows, "text_", terms).select("key", "ord", "type", "term", "n")


def extract(clauses: DataFrame, kept: DataFrame, cfg: SpecConfig) -> tuple[DataFrame, DataFrame]:
    """(entities, relations) that need no model, merged by id; kept are the relevant clauses."""
    procs = checkpointed(procedures(clauses, kept))  # entities and both ends of relations are made of them
    named = procs.select(ordinal(F.col("prio"), F.col("o.ord"), F.col("o.depth")).alias("ord"), "type", "label", "clause", "anchor", "extractor", "confidence", "review")
    none = F.lit(None).cast("string")
    words = vocabulary_hits(kept, cfg)
    words = words.select(ordinal(F.lit(2), F.col("ord"), F.col("n")).alias("ord"), "type", F.col("term").alias("label"), F.col("key").alias("clause"), F.col("term").alias("anchor"), F.concat(F.lit("deterministic:vocab:"), "type").alias("extractor"), none.alias("confidence"), none.alias("review"))
    entities = merge_records(entity_records(named.unionByName(words), cfg), "defined_in")
    return entities, cross_references(kept, procs, cfg)


def cross_references(kept: DataFrame, procs: DataFrame, cfg: SpecConfig) -> DataFrame:
    """INVOKES relations: a kept procedure clause names another procedure's clause; the first of each id."""
    ids = first_by(procs, ["at"], "prio", F.col("o")).select("at", X.canonical_id(F.col("type"), F.col("label"), F.lit(cfg.spec)).alias("pid"))
    text = F.coalesce("text", F.lit(""))
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(CROSS_REFERENCE), F.lit(1)).alias("target"), F.regexp_extract_all(text, F.lit(CROSS_REFERENCE), F.lit(0)).alias("anchor"))
    refs = kept.where(~F.contains("key", F.lit("/"))).select("ord", "key", F.coalesce("number", "key").alias("at"), F.posexplode(found).alias("pos", "m"))
    refs = refs.join(ids.withColumnRenamed("pid", "src"), "at")
    refs = refs.join(ids.select(F.col("at").alias("target"), F.col("pid").alias("dst")), F.col("m")["target"] == F.col("target")).where("src <> dst")
    none = F.lit(None).cast("string")
    rows = refs.select(ordinal(F.lit(0), F.col("ord"), F.col("pos")).alias("ord"), F.lit("INVOKES").alias("type"), "src", "dst", F.col("key").alias("clause"), F.col("m")["anchor"].alias("anchor"), none.alias("modality"), F.lit("high").alias("confidence"), F.lit("xref").alias("procedure_ctx"), none.alias("extractor"))
    return first_by(relation_records(rows, cfg), ["id"], "ord")
