"""Reports over written runs, as text, and their command line: triage, compare, evaluate, align and retype; and pages to look
at: the view of a run's graph, the facts of its clauses, the tree of its concepts.

    spark-submit reports.py triage --snapshots DIR --spec "TS 38.331" --version 19.2.0 [--label L] [--out FILE]
    spark-submit reports.py view --store DIR [--types A,B] [--since L] --out FILE --snapshots ... --spec ... --version ...

Every table behind a report is a DataFrame of its own; a report shows a bounded number of its rows.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable
from itertools import combinations
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import comparison, graphs, panels, review, validation
from ..schema import RETYPE_RULES, Ontology, Options, SpecConfig
from ..sources import exports, stores
from ..storage import checkpointed
from .run import _named


def table_lines(title: str, rows: DataFrame, order: Iterable, most: int) -> list[str]:
    """A heading, and up to ``most`` rows in order, a line each; how many more there are is said."""
    held = rows.orderBy(*order).limit(most + 1).collect()
    lines = [f"== {title}"] + ["  " + "  ".join(f"{c}={v}" for c, v in r.asDict().items()) for r in held[:most]]
    return lines + (["  ... and more"] if len(held) > most else [])


def triage(entities: DataFrame, relations: DataFrame, found: DataFrame, warned: DataFrame | None = None, ontology: Ontology | None = None, top: int = 15, samples: int = 3) -> str:
    """Errors by category, the most frequent shapes of each kind with samples, what dangling ends may mean, reversed edges."""
    o = ontology or Ontology()
    lines = table_lines("errors by category", validation.by_category(found), [F.desc("n"), "cat"], 20)
    slots = found.where(F.col("cat").isin(*validation.CATEGORIES[4:6])).select(F.concat_ws(" ", "rel", "slot", "got").alias("shape"), "id", F.struct("row_ord", "rule_ord").alias("o"))
    lines += table_lines("violated ends", validation.ranked_samples(slots, "shape", "id", "o", top, samples), ["rank"], top)
    odd = found.where(F.col("cat").isin(*validation.CATEGORIES[:2])).groupBy("what", "got").agg(F.count(F.lit(1)).alias("n"))
    lines += table_lines("undeclared types", odd, [F.desc("n"), "what", "got"], top)
    lost = found.where(F.col("cat").isin(*validation.CATEGORIES[2:4])).select("ref")
    misses = validation.near_misses(lost, entities, [t for t, _ in o.entity_types])
    lines += table_lines("unknown ends", validation.dangling_summary(found, misses), [F.desc("findings"), "rule", "bucket"], top)
    lines += table_lines("reversed edges", validation.reversed_edges(entities, relations, o), [F.desc("n"), "type"], top)
    lines += table_lines("violations, by entities of undeclared types, at both ends", validation.collateral(found, entities, relations, o), ["violations"], 1)
    if warned is not None:
        lines += table_lines("warnings", warned.groupBy("cat").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), "cat"], top)
    return "\n".join(lines)


def compare(entities: DataFrame, relations: DataFrame, samples: int = 8) -> str:
    """Runs of one specification (rows with run): counts of each, common and own ids of each pair, objects that differ."""
    run, empty = F.col("run").alias("label"), F.lit(None).cast("string")
    ids = entities.select(run, "id")
    lines = table_lines("entities of each run", comparison.run_counts(entities.select(run, "extractor", empty.alias("procedure_ctx"))), ["label"], 50)
    lines += table_lines("relations of each run", comparison.run_counts(relations.select(run, "extractor", "procedure_ctx")), ["label"], 50)
    lines += table_lines("entities of pairs of runs", comparison.set_compare(ids), ["label_a", "label_b"], 100)
    lines += table_lines("relations of pairs of runs", comparison.set_compare(relations.select(run, "id")), ["label_a", "label_b"], 100)
    labels = sorted(r.label for r in ids.select("label").distinct().collect())
    for a, b in combinations(labels, 2):
        own = comparison.set_differences(*(ids.where(F.col("label") == x).select("id") for x in (a, b)))
        lines += table_lines(f"only in one of {a} and {b}", own, ["side", "id"], samples)
        differ = comparison.object_divergence(*(relations.where(F.col("run") == x) for x in (a, b)))
        lines += table_lines(f"objects that differ between {a} and {b}", differ, ["src", "type"], samples)
    return "\n".join(lines)


def evaluation(gold: tuple[DataFrame, DataFrame], entities: DataFrame, relations: DataFrame, suggestions: DataFrame, most: int = 100) -> str:
    """Recall, precision and supported model relations against curated truth without its scaffold, and what no entity matches."""
    gold_entities, gold_relations = stores.without_scaffold(*gold)
    scores = comparison.evaluate(gold_entities, gold_relations, entities, relations, comparison.alias_map(suggestions))
    scores = scores.withColumn("unsupported", comparison.unsupported_fraction(F.col("matched"), F.col("total")))
    lines = table_lines("scores by type (none: all)", scores, ["part", "measure", F.col("type").asc_nulls_first()], most)
    return "\n".join(lines + table_lines("unmatched", comparison.unmatched_gold(gold_entities, entities), ["id"], most))


def alignment(suggestions: DataFrame, rho: float, samples: int = 8) -> str:
    """What another cutoff would propose, from stored distances: nothing is computed anew."""
    lines = table_lines("proposals", suggestions.groupBy(F.when(F.col("exact") < rho, "merge").otherwise("new-entity").alias("proposal")).agg(F.count(F.lit(1)).alias("n")), ["proposal"], 5)
    lines += table_lines("distances", review.distance_histogram(suggestions), ["lo"], 20)
    return "\n".join(lines + table_lines(f"next to {rho}", review.boundary(suggestions, rho, samples).select("side", "place", "surface_id", "canonical_id", "distance"), ["side", "place"], 2 * samples))


def retype(entities: DataFrame, relations: DataFrame, rules: DataFrame, ontology: Ontology | None = None) -> tuple[str, dict[str, DataFrame]]:
    """What the rules change and the errors by category before and after, and the tables of the retyped run."""
    o, keys = ontology or Ontology(), ("spec", "version", "run")
    entities, relations = entities.drop(*keys), relations.drop(*keys)
    plan = validation.retype_plan(entities, relations, rules)
    after = checkpointed(validation.retyped(entities, relations, rules))
    found = [checkpointed(validation.findings(entities, r, o)) for r in (relations, after)]
    lines = table_lines("relations to retype", plan.groupBy("old_type", "new_type").agg(F.count(F.lit(1)).alias("n")), ["old_type", "new_type"], 50)
    counts = [f.groupBy("cat").agg(F.count(F.lit(1)).alias(n)) for f, n in zip(found, ("before", "after"), strict=True)]
    both = counts[0].join(counts[1], "cat", "full").select("cat", *(F.coalesce(n, F.lit(0)).alias(n) for n in ("before", "after")))
    lines += table_lines("errors before and after", both, ["cat"], 50)
    return "\n".join(lines), {"entities": entities, "relations": after, "findings": found[1]}


def view(entities: DataFrame, relations: DataFrame, clauses: DataFrame, release: str, title: str, types: Iterable[str] = (), seen: DataFrame | None = None) -> str:
    """The page of a run's graph; with ``types`` of those relations and their ends, with ``seen`` of relations not in it."""
    nodes, edges = graphs.view_nodes(entities, clauses, release), graphs.view_edges(entities, relations, clauses, release)
    keep = F.col("label").isin(*types) if types else F.lit(True)
    if types or seen is not None:
        nodes, edges = graphs.focused(nodes, edges if seen is None else graphs.new_since(edges, seen), keep)
    return exports.view_page(nodes, edges, title)


def facts(entities: DataFrame, relations: DataFrame, clauses: DataFrame, release: str, title: str, types: Iterable[str] = ()) -> str:
    """The page of the clauses that show relations (of ``types``), with those marked in their texts."""
    shown = relations.where(F.col("type").isin(*types)) if types else relations
    rows = checkpointed(panels.clause_facts(clauses, entities, shown, release))
    return exports.facts_page(panels.marked_texts(clauses, rows), rows, title)


def concepts(entities: DataFrame, relations: DataFrame, title: str) -> str:
    """The page of a run's concept tree."""
    return exports.concept_page(panels.concept_tree(panels.concepts_of(entities, relations), entities, relations), title)


PAGES = ("view", "facts", "concepts")


def main(argv: list[str] | None = None) -> None:
    from ..session import local_session

    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("report", choices=("triage", "compare", "evaluate", "align", "retype", *PAGES))
    for name in ("--snapshots", "--spec", "--version"):
        p.add_argument(name, required=True)
    p.add_argument("--label", help="the run; compare takes several, comma-separated, and all without")
    p.add_argument("--gold", default="gold", help="the label of the curated truth")
    p.add_argument("--rho", type=float)
    p.add_argument("--samples", type=int, default=8)
    p.add_argument("--write-label", help="where retype writes its run and align its new suggestions (the same run is allowed); without, they only report")
    p.add_argument("--recompute", action="store_true", help="align: measure all distances of the run anew")
    p.add_argument("--embed", help="module:function that gives labels' vectors, for --recompute")
    p.add_argument("--store", help="view, facts: the clause store of the run")
    p.add_argument("--types", default="", help="view, facts: these types of relations alone, comma-separated")
    p.add_argument("--since", help="view: what this run does not have")
    p.add_argument("--out", help="a file for the report")
    a = p.parse_args(argv)
    if a.report in PAGES and not (a.out and (a.store or a.report == "concepts")):
        p.error(f"{a.report} needs --out" + ("" if a.report == "concepts" else " and --store"))
    spark = SparkSession.getActiveSession() or local_session()
    cfg, snapshots = SpecConfig(a.spec, a.version), stores.Snapshots(spark, a.snapshots)
    read = lambda table, label=a.label or "default", optional=False: snapshots.read(table, cfg.compact, cfg.version, label, optional)
    if a.report == "triage":
        text = triage(read("entities"), read("relations"), read("findings"), samples=a.samples)
    elif a.report == "compare":
        chosen = [x.strip() for x in (a.label or "").split(",") if x.strip()]
        rows = [snapshots.read(t, cfg.compact, cfg.version) for t in ("entities", "relations")]
        text = compare(*[r.where(F.col("run").isin(*chosen)) if chosen else r for r in rows], a.samples)
    elif a.report == "evaluate":
        text = evaluation((read("entities", a.gold), read("relations", a.gold)), read("entities"), read("relations"), read("aliases", optional=True))
    elif a.report == "align":
        rho, suggestions = Options.of(spark, rho=a.rho).rho, None
        if a.recompute:
            suggestions = checkpointed(review.aligned(read("entities"), Ontology().compatible(spark), rho, _named(a.embed)))
            if a.write_label:
                snapshots.write("aliases", suggestions, cfg, a.write_label)
        text = alignment(read("aliases") if suggestions is None else suggestions, rho, a.samples)
    elif a.report in PAGES:
        title, types = f"{a.spec} {a.version} {a.label or ''}".strip(), [x.strip() for x in a.types.split(",") if x.strip()]
        graph = (read("entities"), read("relations"))
        if a.report == "concepts":
            page = concepts(*graph, title)
        else:
            clauses = stores.read_store(spark, a.store).where((F.col("spec") == a.spec) & (F.col("version") == a.version))
            seen = read("relations", a.since).select("id") if a.since else None
            page = facts(*graph, clauses, cfg.release, title, types) if a.report == "facts" else view(*graph, clauses, cfg.release, title, types, seen)
        Path(a.out).write_text(page, encoding="utf-8")
        print(f"{a.report} of {title}: {a.out}")
        return
    else:
        rules = spark.createDataFrame(list(RETYPE_RULES), "type string, src_type string, dst_type string, new_type string")
        text, tables = retype(read("entities"), read("relations"), rules)
        if a.write_label:
            snapshots.commit(tables, cfg, a.write_label)
    if a.out:
        Path(a.out).write_text(text + "\n", encoding="utf-8")
    print(text)


if __name__ == "__main__":
    main()
