"""Validation as one table of findings; messages, counts and triage derive from it.

The rules, in order: undeclared entity types; for each relation an undeclared type (which ends that relation's checks),
missing ends, types outside the ends' allowed ones; lifecycle fields. Provenance checks against the corpus give warnings.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..schema import Ontology
from .merging import first_by

#: Categories of errors in order of report.
CATEGORIES = (
    "entity-undeclared-type", "relation-undeclared-type", "dangling-from", "dangling-to", "domain-violation", "range-violation",
    "lifecycle-release", "lifecycle-field", "lifecycle-supersedes",
)
_COLUMNS = ("rule_ord", "row_ord", "cat", "id", "rel", "slot", "ref", "got", "allowed", "what", "field")


def typed_ends(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """relations with src_type, dst_type, src_label, dst_label of their ends' entities; of equal ids the last entity holds."""
    known = first_by(entities.select("id", "type", "label", "ord"), ["id"], "ord", last=True)
    for end in ("src", "dst"):
        side = known.select(F.col("id").alias(end), F.col("type").alias(f"{end}_type"), F.col("label").alias(f"{end}_label"), F.lit(True).alias(f"{end}_known"))
        relations = relations.join(side, end, "left")
    return relations


def fitting(typed: DataFrame, ontology: Ontology) -> DataFrame:
    """typed relations with src_ok, dst_ok and, with ends exchanged, src_swapped, dst_swapped; null types fit nowhere.

    One join with the relation types, which are a few hundred rows at most, each with the types that its ends allow.
    """
    spark = typed.sparkSession
    slots = ontology.allowed(spark).groupBy(F.col("rel").alias("type")).agg(*[F.collect_set(F.when(F.col("slot") == s, F.struct(F.col("type").alias("t"))["t"])).alias(f"{s}_allowed") for s in ("src", "dst")])
    wild = ontology.wildcards(spark).groupBy(F.col("rel").alias("type")).agg(*[F.max(F.col("slot") == s).alias(f"{s}_wild") for s in ("src", "dst")])
    typed = typed.join(F.broadcast(slots.join(wild, "type", "full")), "type", "left")
    for slot, end, name in (("src", "src", "src_ok"), ("dst", "dst", "dst_ok"), ("src", "dst", "src_swapped"), ("dst", "src", "dst_swapped")):
        fits = F.coalesce(f"{slot}_wild", F.lit(False)) | F.coalesce(F.array_contains(f"{slot}_allowed", F.col(f"{end}_type")), F.lit(False))
        typed = typed.withColumn(name, fits & F.col(f"{end}_type").isNotNull())
    return typed.drop("src_allowed", "dst_allowed", "src_wild", "dst_wild")


def _found(rule: int, **values: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(rule).alias("rule_ord"), F.lit(CATEGORIES[rule]).alias("cat"), *[values.get(c, none).cast("string").alias(c) for c in _COLUMNS[4:]])


def _lifecycle(rows: DataFrame, what: str, releases: Column) -> Column:
    """Findings of a row's lifecycle fields that can be told from the row alone."""
    unknown = lambda r: r.isNotNull() & ~F.array_contains(releases, r)
    observed = F.transform(F.filter("observed_in", lambda r: ~F.array_contains(releases, r)), lambda r: _found(6, got=r, what=F.lit(what), field=F.lit("observed_in")))
    fields = [F.when(unknown(F.col(c)), _found(7, got=F.col(c), what=F.lit(what), field=F.lit(c))) for c in ("introduced_in", "valid_until")]
    return F.concat(F.coalesce(observed, F.array()), F.array_compact(F.array(*fields)))


def findings(entities: DataFrame, relations: DataFrame, ontology: Ontology | None = None, subtypes: bool = True) -> DataFrame:
    """Errors: (rule_ord, row_ord, cat, id, rel, slot, ref, got, allowed, what, field, pseudo).

    Without subtypes an end's type must be one that the slot names itself. Entities and relations are read once each: a row
    gives the list of its findings. Only ids that are superseded need a further join.
    """
    ontology = ontology or Ontology()
    if not subtypes:
        ontology = replace(ontology, entity_types=tuple((t, None) for t, _ in ontology.entity_types))
    spark = entities.sparkSession
    types = F.broadcast(ontology.types(spark).select("type", F.lit(True).alias("declared")))
    rules = F.broadcast(ontology.relations(spark).withColumnRenamed("rel", "type").withColumn("declared", F.lit(True)))
    releases = F.array(*[F.lit(r) for r in ontology.releases])
    c = F.col
    spread = lambda rows, lists: rows.select(c("ord").cast("long").alias("row_ord"), "id", F.inline(F.concat(*lists)))
    own = F.array_compact(F.array(F.when(c("declared").isNull(), _found(0, got=c("type"), what=F.lit("entity")))))
    out = spread(entities.join(types, "type", "left"), [own, _lifecycle(entities, "entity", releases)])
    typed = fitting(typed_ends(relations.join(rules, "type", "left"), entities), ontology)
    known, relation = c("declared").isNotNull(), F.lit("relation")
    ends = [F.when(~known, _found(1, rel=c("type"), got=c("type"), what=relation))]
    for i, (end, name) in enumerate((("src", "from"), ("dst", "to"))):
        ends.append(F.when(known & c(f"{end}_known").isNull(), _found(2 + i, rel=c("type"), slot=F.lit(name), ref=c(end), what=relation)))
        wrong = known & c(f"{end}_type").isNotNull() & ~c(f"{end}_ok")
        ends.append(F.when(wrong, _found(4 + i, rel=c("type"), slot=F.lit(name), ref=c(end), got=c(f"{end}_type"), allowed=c(("domain", "range")[i]), what=relation)))
    out = out.unionByName(spread(typed, [F.array_compact(F.array(*ends)), _lifecycle(relations, "relation", releases)]))
    named = lambda rows, what: rows.select("ord", "id", "supersedes", F.lit(what).alias("what"))
    ids = entities.select(c("id").alias("supersedes")).union(relations.select("id")).distinct()
    lost = named(entities, "entity").unionByName(named(relations, "relation")).where("supersedes is not null").join(ids, "supersedes", "left_anti")
    out = out.unionByName(spread(lost, [F.array(_found(8, got=c("supersedes"), what=c("what"), field=F.lit("supersedes")))]))
    pseudo = ontology.relations(spark).select("rel", c("pseudo_src").alias("ps"), c("pseudo_dst").alias("pd"))
    flagged = out.join(F.broadcast(pseudo), "rel", "left")
    slot = F.when(c("slot") == "from", c("ps")).when(c("slot") == "to", c("pd"))
    return flagged.withColumn("pseudo", F.coalesce(slot, F.lit(False))).select(*_COLUMNS, "pseudo")


def warnings(entities: DataFrame, relations: DataFrame, haystacks: DataFrame, version: str) -> DataFrame:
    """(row_ord, what, id, pos, clause, anchor, cat): provenance of the version that the corpus (key, hay_norm) does not bear out.

    Curated and external items and other versions are not checked; a relation's item without a clause neither, an entity's is.
    """
    shape = lambda df, what, c: df.select(F.col("ord").cast("long").alias("row_ord"), F.lit(what).alias("what"), "id", F.posexplode(c).alias("pos", "p"))
    items = shape(entities, "entity", "defined_in").unionByName(shape(relations, "relation", "provenance"))
    items = items.where(~F.coalesce("p.curated", F.lit(False)) & ~F.coalesce("p.external", F.lit(False)) & (F.col("p.version") == version))
    items = items.where((F.col("what") == "entity") | F.col("p.clause").isNotNull())
    joined = items.join(haystacks.select(F.col("key"), "hay_norm"), F.col("p.clause") == F.col("key"), "left")
    cat = F.when(F.col("key").isNull(), "clause-missing").when(~X.anchor_in(F.col("hay_norm"), F.col("p.anchor")), "anchor-missing")
    return joined.select("row_ord", "what", "id", "pos", F.col("p.clause").alias("clause"), F.col("p.anchor").alias("anchor"), cat.alias("cat")).where("cat is not null")


def messages(found: DataFrame) -> DataFrame:
    """found with message: one line for each error. The wordings are fixed values."""
    c = F.col
    text = (
        F.when(c("cat") == CATEGORIES[0], F.format_string("entity %s undeclared type %s", c("id"), c("got")))
        .when(c("cat") == CATEGORIES[1], F.format_string("relation %s undeclared type %s", c("id"), c("got")))
        .when(c("cat").isin(*CATEGORIES[2:4]), F.format_string("relation %s %s unknown entity %s", c("id"), c("slot"), c("ref")))
        .when(c("cat") == CATEGORIES[4], F.format_string("relation %s (%s): from-type %s not in domain %s", c("id"), c("rel"), c("got"), c("allowed")))
        .when(c("cat") == CATEGORIES[5], F.format_string("relation %s (%s): to-type %s not in range %s", c("id"), c("rel"), c("got"), c("allowed")))
        .when(c("cat") == CATEGORIES[6], F.format_string("%s %s observed_in %s not a known release", c("what"), c("id"), c("got")))
        .when(c("cat") == CATEGORIES[7], F.format_string("%s %s %s=%s not a known release", c("what"), c("id"), c("field"), c("got")))
        .otherwise(F.format_string("%s %s supersedes unknown id %s", c("what"), c("id"), c("got")))
    )
    return found.withColumn("message", text)


def by_category(found: DataFrame) -> DataFrame:
    """(cat, n, share): findings of each category and their share of all, in percent."""
    n = found.groupBy("cat").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(W.partitionBy()), 2))


def reversed_edges(entities: DataFrame, relations: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    """(type, n): relations whose ends are both wrong as they are and both right exchanged."""
    fit = fitting(typed_ends(relations, entities), ontology or Ontology())
    return fit.where("not src_ok and not dst_ok and src_swapped and dst_swapped").groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def retype_plan(entities: DataFrame, relations: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, old_type, new_type) of relations whose shape (type, src_type, dst_type) a rule (…, new_type) names."""
    typed = typed_ends(relations, entities)
    return typed.join(F.broadcast(rules), ["type", "src_type", "dst_type"]).select("id", F.col("type").alias("old_type"), "new_type")


def retyped(entities: DataFrame, relations: DataFrame, rules: DataFrame) -> DataFrame:
    """relations with the new types of the plan."""
    typed = typed_ends(relations, entities).join(F.broadcast(rules), ["type", "src_type", "dst_type"], "left")
    return typed.withColumn("type", F.coalesce("new_type", "type")).select(*relations.columns)


def near_misses(refs: DataFrame, entities: DataFrame, type_words: list[str]) -> DataFrame:
    """(ref, rule, target) for dangling ids: what else they may mean, by the strictest rule that finds an entity.

    Rules: letter case only; separators only; a repeated type word before the name, in the same bucket; the same name in
    another bucket; unresolved. Of several entities the first in ``ord`` is taken. Each rule is one equi-join.
    """
    name = lambda c: X.norm_id(X.bare_name(c, type_words))
    ids = entities.select("id", "ord")
    pick = lambda keys, as_: ids.select(*keys, "id", "ord").groupBy(*as_[:-1]).agg(F.min_by("id", "ord").alias(as_[-1]))
    lower = pick([F.lower("id").alias("lower_")], ["lower_", "by_case"])
    norm = pick([X.norm_id(F.col("id")).alias("norm_")], ["norm_", "by_separator"])
    same = pick([name(F.col("id")).alias("name_"), X.bucket_of(F.col("id")).alias("bucket_")], ["name_", "bucket_", "by_prefix"])
    other = pick([name(F.col("id")).alias("name_")], ["name_", "by_name"])
    r = refs.select("ref").distinct()
    r = r.withColumns({"lower_": F.lower("ref"), "norm_": X.norm_id(F.col("ref")), "name_": name(F.col("ref")), "bucket_": X.bucket_of(F.col("ref")), "worded": X.bare_name(F.col("ref"), type_words) != X.name_of(F.col("ref"))})
    r = r.join(lower, "lower_", "left").join(norm, "norm_", "left").join(same, ["name_", "bucket_"], "left").join(other, "name_", "left")
    case = F.col("by_case").isNotNull() & (F.col("by_case") != F.col("ref"))
    sep = F.col("by_separator").isNotNull() & (F.col("by_separator") != F.col("ref"))
    prefix = F.col("by_prefix").isNotNull() & F.col("worded")
    rule = F.when(case, "case-only").when(sep, "separator").when(prefix, "type-word-prefix").when(F.col("by_name").isNotNull(), "wrong-type-bucket").otherwise("UNRESOLVED")
    target = F.when(case, F.col("by_case")).when(sep, F.col("by_separator")).when(prefix, F.col("by_prefix")).otherwise(F.col("by_name"))
    return r.select("ref", rule.alias("rule"), target.alias("target"))


def dangling_summary(found: DataFrame, misses: DataFrame) -> DataFrame:
    """(rule, bucket, refs, findings): dangling ends by what they may mean, weighted by the findings that name them."""
    lost = found.where(F.col("cat").isin(*CATEGORIES[2:4]))
    joined = lost.join(misses, "ref", "left")
    rule = F.when(F.col("pseudo"), "pseudo-type-target").otherwise(F.col("rule"))
    return joined.groupBy(rule.alias("rule"), X.bucket_of(F.col("ref")).alias("bucket")).agg(F.countDistinct("ref").alias("refs"), F.count(F.lit(1)).alias("findings"))


#: Groups that a pattern's rows are dealt to before their first ones are found.
SALTS = 64


def ranked_samples(rows: DataFrame, pattern: str, sample: str, order: str, top: int, k: int) -> DataFrame:
    """(pattern, n, more, rank, samples): the most frequent patterns, ties by pattern, with the first k samples of each.

    Patterns are counted and cut to ``top`` by aggregation. Of those alone, the first k of each of ``SALTS`` groups of rows are
    ranked, which Spark cuts before the shuffle, and then the first k of those; no task holds a pattern's rows.
    """
    counts = rows.groupBy(F.col(pattern).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.orderBy(F.desc("n"), "pattern").limit(top)
    best = best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("n"), "pattern")))
    shown = rows.select(F.col(pattern).alias("p_"), F.col(sample).alias("s"), F.col(order).alias("o"))
    shown = shown.join(F.broadcast(best.select(F.col("pattern").alias("p_"))), "p_")
    shown = shown.withColumn("salt", F.pmod(F.xxhash64("o", "s"), F.lit(SALTS)))
    first = lambda df, *by: df.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy("o", "s"))).where(F.col("r") <= k)
    winners = first(first(shown, "p_", "salt").drop("r"), "p_")
    lists = winners.groupBy(F.col("p_").alias("pattern")).agg(F.array_sort(F.collect_list(F.struct("r", "s"))).alias("l"))
    joined = best.join(lists, "pattern", "left")
    return joined.select("pattern", "n", F.greatest(F.col("n") - k, F.lit(0)).alias("more"), "rank", F.array_join(F.transform(F.coalesce("l", F.array().cast(lists.schema["l"].dataType)), lambda x: x["s"].cast("string")), ",").alias("samples"))


def collateral(found: DataFrame, entities: DataFrame, relations: DataFrame, ontology: Ontology | None = None) -> DataFrame:
    """(violations, collateral, doubled): slot violations, those that touch an entity of an undeclared type, and relations wrong at both ends."""
    types = (ontology or Ontology()).types(entities.sparkSession).select("type")
    odd = entities.join(F.broadcast(types), "type", "left_anti").select(F.col("id").alias("ref"), F.lit(True).alias("odd")).distinct()
    slots = found.where(F.col("cat").isin(*CATEGORIES[4:6]))
    both = slots.groupBy("id").agg(F.countDistinct("slot").alias("s")).where("s > 1").select("id", F.lit(True).alias("double")).distinct()
    joined = slots.join(odd, "ref", "left").join(both, "id", "left")
    return joined.agg(F.count(F.lit(1)).alias("violations"), F.count("odd").alias("collateral"), F.countDistinct(F.when(F.col("double"), F.col("id"))).alias("doubled"))


