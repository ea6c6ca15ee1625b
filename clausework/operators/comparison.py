"""Runs against runs, and runs against curated truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .merging import first_by


def run_counts(records: DataFrame) -> DataFrame:
    """(label, records, model, deterministic) for records (label, extractor, procedure_ctx); cross-references are deterministic."""
    fixed = F.startswith(F.coalesce("extractor", F.lit("")), F.lit("deterministic")) | (F.coalesce("procedure_ctx", F.lit("")) == "xref")
    return records.groupBy("label").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("extractor") == "llm").alias("model"), F.count_if(fixed).alias("deterministic"))


def set_compare(ids: DataFrame) -> DataFrame:
    """(label_a, label_b, n_a, n_b, both, only_a, only_b, jaccard) of all pairs a < b of labels in (label, id).

    Pairs of labels that share an id come from a self-join on it; sizes give the rest, so nothing is compared pairwise by row.
    """
    rows = ids.select("label", "id").distinct()
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    a, b = rows.select(F.col("label").alias("label_a"), "id"), rows.select(F.col("label").alias("label_b"), "id")
    shared = a.join(b, "id").where("label_a < label_b").groupBy("label_a", "label_b").agg(F.count(F.lit(1)).alias("both"))
    pairs = sizes.select(F.col("label").alias("label_a"), F.col("n").alias("n_a")).join(sizes.select(F.col("label").alias("label_b"), F.col("n").alias("n_b")), F.col("label_a") < F.col("label_b"))
    out = pairs.join(shared, ["label_a", "label_b"], "left").withColumn("both", F.coalesce("both", F.lit(0)))
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return out.select("label_a", "label_b", "n_a", "n_b", "both", (F.col("n_a") - F.col("both")).alias("only_a"), (F.col("n_b") - F.col("both")).alias("only_b"), F.coalesce(F.bround(F.try_divide(F.col("both").cast("double"), union.cast("double")), 3), F.lit(1.0)).alias("jaccard"))


def set_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(id, side): ids of only one of two tables."""
    one = lambda x, y, s: x.select("id").distinct().join(y.select("id"), "id", "left_anti").withColumn("side", F.lit(s))
    return one(a, b, "only_a").unionByName(one(b, a, "only_b"))


def object_divergence(a: DataFrame, b: DataFrame) -> DataFrame:
    """(src, type, both, only_a, only_b): subjects and relations of both runs (src, type, dst) with different objects, sorted."""
    tagged = a.select("src", "type", "dst", F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(b.select("src", "type", "dst", F.lit(0).alias("in_a"), F.lit(1).alias("in_b")))
    objects = tagged.groupBy("src", "type", "dst").agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    pick = lambda c: F.sort_array(F.collect_list(F.when(c, F.col("dst"))))
    both, only_a, only_b = (F.col("in_a") + F.col("in_b") == 2), F.col("in_b") == 0, F.col("in_a") == 0
    groups = objects.groupBy("src", "type").agg(F.max("in_a").alias("a"), F.max("in_b").alias("b"), pick(both).alias("both"), pick(only_a).alias("only_a"), pick(only_b).alias("only_b"))
    return groups.where("a = 1 and b = 1 and (size(only_a) > 0 or size(only_b) > 0)").drop("a", "b")


def most_common(rows: DataFrame, column: str, order: str) -> DataFrame:
    """(value, n, first): counts of a column's values; sort by n descending, then first seen."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))


def entity_key() -> list[Column]:
    return [F.col("type"), X.norm_label(F.col("label")).alias("norm")]


def match_entities(gold: DataFrame, run: DataFrame) -> DataFrame:
    """(gold_id, run_id): entities of equal type and normalised label; of several in the run the first."""
    keys = run.select(*entity_key(), "id", "ord").groupBy("type", "norm").agg(F.min_by("id", "ord").alias("run_id"))
    return gold.select(F.col("id").alias("gold_id"), *entity_key()).join(keys.hint("merge"), ["type", "norm"]).select("gold_id", "run_id")


def alias_map(suggestions: DataFrame) -> DataFrame:
    """(surface, canonical) of proposed merges; of several for a surface the last."""
    merges = suggestions.where("proposal = 'merge'").select(F.col("surface_id").alias("surface"), F.col("canonical_id").alias("canonical"), "surface_ord")
    return first_by(merges, ["surface"], "surface_ord", last=True).drop("surface_ord")


def evaluate(gold_entities: DataFrame, gold_relations: DataFrame, entities: DataFrame, relations: DataFrame, aliases: DataFrame, resolve_gold: bool = False) -> DataFrame:
    """(part, measure, type, matched, total): recall and precision of entities and relations by type, total as type null.

    Aliases of the run (surface, canonical) count as their canonical for precision and for relations' ends. With
    resolve_gold matched ids are resolved too; without, a gold entity that only a surface matches finds no relation.
    All sides grow with the tables, so joins are merges of shuffled sides: none is sent to the driver for a broadcast.
    """
    match = match_entities(gold_entities, entities)
    if resolve_gold:
        match = match.join(aliases.hint("merge"), F.col("run_id") == F.col("surface"), "left").select("gold_id", F.coalesce("canonical", "run_id").alias("run_id"))
    found = gold_entities.join(match.select(F.col("gold_id").alias("id"), F.lit(True).alias("ok")).distinct().hint("merge"), "id", "left")
    parts = [found.select(F.lit("entities").alias("part"), F.lit("recall").alias("measure"), "type", F.coalesce("ok", F.lit(False)).alias("ok"))]
    gold_keys = gold_entities.select(*entity_key(), F.lit(True).alias("hit")).distinct()
    keyed = entities.select("id", *entity_key(), "ord").join(gold_keys.hint("merge"), ["type", "norm"], "left")
    hits = keyed.where("hit").select(F.col("id").alias("canonical")).distinct().withColumn("via", F.lit(True))
    via = aliases.join(hits.hint("merge"), "canonical").select(F.col("surface").alias("id"), "via").distinct()
    parts.append(keyed.join(via.hint("merge"), "id", "left").select(F.lit("entities").alias("part"), F.lit("precision").alias("measure"), "type", F.coalesce("hit", "via", F.lit(False)).alias("ok")))

    def ended(rows: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
        for end in ("src", "dst"):
            rows = rows.join(mapping.select(F.col(key).alias(end), F.col(value).alias(f"{end}_m")).hint("merge"), end, "left")
        return rows

    resolved = ended(relations.select("type", "src", "dst", "extractor"), aliases, "surface", "canonical").select("type", "extractor", F.coalesce("src_m", "src").alias("src"), F.coalesce("dst_m", "dst").alias("dst"))
    have = resolved.select("type", F.col("src").alias("src_m"), F.col("dst").alias("dst_m"), F.lit(True).alias("ok")).distinct()
    wanted = ended(gold_relations.select("type", "src", "dst"), match, "gold_id", "run_id").join(have.hint("merge"), ["type", "src_m", "dst_m"], "left")
    parts.append(wanted.select(F.lit("relations").alias("part"), F.lit("recall").alias("measure"), "type", F.coalesce("ok", F.lit(False)).alias("ok")))
    back = match.groupBy("run_id").agg(F.min("gold_id").alias("gold_id"))
    truth = gold_relations.select("type", F.col("src").alias("src_m"), F.col("dst").alias("dst_m"), F.lit(True).alias("ok")).distinct()
    backed = ended(resolved, back, "run_id", "gold_id").join(truth.hint("merge"), ["type", "src_m", "dst_m"], "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    parts.append(backed.select(F.lit("relations").alias("part"), F.lit("precision").alias("measure"), "type", "ok"))
    parts.append(backed.where("extractor = 'llm'").select(F.lit("model relations").alias("part"), F.lit("supported").alias("measure"), "type", "ok"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return tally(rows, ["part", "measure"])


def tally(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, type, matched, total) of rows (by, type, ok), and totals over types as type null."""
    levels = F.explode(F.array(F.col("type"), F.lit(None).cast("string")))
    return rows.select(*by, levels.alias("type"), "ok").groupBy(*by, "type").agg(F.count_if(F.col("ok")).alias("matched"), F.count(F.lit(1)).alias("total"))


def unsupported_fraction(matched: Column, total: Column) -> Column:
    """1 - matched / total to three places; null for none."""
    return F.bround(F.lit(1.0) - F.try_divide(matched.cast("double"), total.cast("double")), 3)


def unmatched_gold(gold: DataFrame, run: DataFrame) -> DataFrame:
    return gold.join(match_entities(gold, run).select(F.col("gold_id").alias("id")), "id", "left_anti").select("id")
