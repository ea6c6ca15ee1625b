"""An extraction run: filter, deterministic spine, model facts, merge, validate, align, review, write."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus, extraction, merging, review, validation
from ..provider import SENTINEL, Provider, facts_of, replies
from ..schema import Ontology, Options, SpecConfig
from ..sources import stores
from ..storage import checkpointed
from ..streaming.asking import ask_all
from .metrics import RunMetrics

#: Examples are part of every request, so there are few: more than this is an error.
MOST_EXAMPLES = 20


@dataclass
class Result:
    entities: DataFrame
    relations: DataFrame
    findings: DataFrame
    warnings: DataFrame
    aliases: DataFrame
    review: DataFrame
    report: DataFrame


def build(clauses: DataFrame, cfg: SpecConfig, facts: DataFrame | None = None, scope: str | None = None, rho: float = 0.18, ontology: Ontology | None = None, embed: Callable | None = None, metrics: RunMetrics | None = None) -> Result:
    """The result of a run over clauses, with model facts (clause_ord, clause, facts) if there are any."""
    metrics = metrics or RunMetrics(None)
    metrics.begin("extract")
    ontology = ontology or Ontology()
    filtered = corpus.relevance(clauses, cfg)
    kept = filtered.where("kept")
    if scope:
        kept = kept.where(corpus.in_scope(F.col("key"), scope))
    entities, relations = extraction.extract(clauses, kept, cfg)
    if facts is not None:
        facts = checkpointed(facts)  # both tables come from the same replies, and each is asked for once
        flat = facts.select("clause_ord", "clause", F.posexplode("facts").alias("pos", "f")).select("clause_ord", "clause", "pos", "f.*")
        more_e, more_r = merging.facts_to_records(flat, cfg)
        late = F.col("ord") + (4 << (merging.CLAUSE_BITS + merging.PLACE_BITS))  # behind all that needs no model
        entities = merging.merge_records(entities.unionByName(more_e.withColumn("ord", late)), "defined_in")
        relations = merging.merge_records(relations.unionByName(more_r.withColumn("ord", late)), "provenance")
    measures = {"model_made": F.count_if(F.col("extractor") == "llm")}
    entities = checkpointed(metrics.watched("extract", entities, entities=F.count(F.lit(1)), entities_model=measures["model_made"]))
    relations = checkpointed(metrics.watched("extract", relations, relations=F.count(F.lit(1)), relations_model=measures["model_made"]))
    metrics.end("extract")
    found = validation.findings(entities, relations, ontology)
    warned = validation.warnings(entities, relations, corpus.haystacks(clauses), cfg.version)
    aliases = review.aligned(entities, ontology.compatible(clauses.sparkSession), rho, embed)
    return Result(entities, relations, found, warned, aliases, review.review_queue(entities, relations, warned, aliases), corpus.relevance_report(filtered))


def shown_examples(spark: SparkSession, path: str | None) -> list[dict]:
    """Few-shot examples in order of clause and title; too many to be part of each request are an error."""
    if not path:
        return []
    rows = stores.read_examples(spark, path).orderBy("clause", "title").limit(MOST_EXAMPLES + 1).collect()
    if len(rows) > MOST_EXAMPLES:
        raise ValueError(f"more than {MOST_EXAMPLES} examples in {path}")
    return [r.asDict(recursive=True) for r in rows]


def model_facts(work: DataFrame, clauses: DataFrame, cfg: SpecConfig, provider: Provider, options: Options, log: str | None = None, resume: bool = False, model: str = "none", ontology: Ontology | None = None, examples: list[dict] = (), metrics: RunMetrics | None = None, batch: int | None = None) -> DataFrame:
    """(clause_ord, clause, facts) of a worklist. With a log, replies are kept batch by batch (of about ``batch`` clauses), and a
    run can go on from there."""
    spark, metrics = work.sparkSession, metrics or RunMetrics(None)
    marker = SENTINEL if options.sentinel else None
    ask = lambda rows, keep: facts_of(replies(rows, cfg, provider, options.max_clause_chars, options.retries, options.prompt_variant, None, examples, ontology, options.sentinel, keep), marker)
    if not log:
        return ask(work, False)
    header = {"spec": cfg.spec, "version": cfg.version, "model": model, "prompt_variant": options.prompt_variant, "max_clause_chars": options.max_clause_chars, "sentinel": options.sentinel}
    if resume and stores.exists(spark, log):
        head, records = stores.read_log(spark, log)
        stores.check_header(head, header)
        work, _ = stores.todo(work, records)
    else:
        stores.start_log(spark, log, header)
    work = checkpointed(work)
    metrics.begin("ask", work.count())
    ask_all(work, lambda rows: ask(rows, True), log, batch, seen=lambda got, _: metrics.step("ask", got.where("error is null").count()))
    metrics.end("ask")
    _, records = stores.read_log(spark, log)
    return records.join(clauses.select(F.col("key").alias("clause"), F.col("ord").cast("long").alias("clause_ord")), "clause").select("clause_ord", "clause", "facts")


def run(spark: SparkSession, store: str, snapshots: str, cfg: SpecConfig, provider: Provider | None = None, label: str = "default", log: str | None = None, resume: bool = False, limit: int | None = None, scope: str | None = None, options: Options | None = None, model: str = "none", ontology: Ontology | None = None, examples: str | None = None, embed: Callable | None = None, metrics: RunMetrics | None = None, batch: int | None = None) -> Result:
    """Reads a clause store, runs, and commits a snapshot: all tables of the run at once. With a log, facts are kept as they come
    and a run can go on from it.

    examples is a file of few-shot examples, ontology the user's types, embed a source of vectors for the alignment.
    """
    options, metrics = options or Options.of(spark), metrics or RunMetrics(None)
    clauses = stores.read_store(spark, store)
    facts = None
    if provider is not None:
        kept = corpus.relevance(clauses, cfg).where("kept")
        kept = kept.where(corpus.in_scope(F.col("key"), scope)) if scope else kept
        facts = model_facts(corpus.worklist(kept, limit), clauses, cfg, provider, options, log, resume, model, ontology, shown_examples(spark, examples), metrics, batch)
    result = build(clauses, cfg, facts, scope, options.rho, ontology, embed, metrics)
    metrics.begin("write")
    tables = {"entities": result.entities, "relations": result.relations, "findings": result.findings, "review": result.review, "aliases": result.aliases, "filter": result.report}
    tables["findings"] = metrics.watched("write", tables["findings"], findings=F.count(F.lit(1)))
    tables["review"] = metrics.watched("write", tables["review"], to_review=F.count(F.lit(1)))
    out = stores.Snapshots(spark, snapshots)
    out.commit(tables, cfg, label)
    metrics.end("write")
    out.write("metrics", metrics.table(spark), cfg, label)
    return result


def _named(name: str | None) -> Callable | None:
    """The function that ``module:function`` names."""
    if not name:
        return None
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> None:
    """spark-submit entry: a run, with a model if one is named, and its errors by category."""
    from ..session import local_session

    p = argparse.ArgumentParser(description=__doc__)
    for name in ("--store", "--snapshots", "--spec", "--version"):
        p.add_argument(name, required=True)
    p.add_argument("--label", default="default")
    p.add_argument("--clauses", help="comma-separated prefixes")
    for name, kind in (("--rho", float), ("--max-clause-chars", int), ("--retries", int), ("--prompt-variant", str), ("--limit", int), ("--batch", int)):
        p.add_argument(name, type=kind)
    p.add_argument("--provider", help="module:function that answers a request; without, the run is deterministic")
    p.add_argument("--embed", help="module:function that gives labels' vectors")
    p.add_argument("--model", default="none", help="the model's name, for the log's header")
    p.add_argument("--log", help="where facts are kept as they come")
    p.add_argument("--resume", action="store_true", help="go on from the log")
    p.add_argument("--sentinel", action="store_true", default=None)
    p.add_argument("--examples", help="a file of few-shot examples")
    p.add_argument("--quiet", action="store_true", help="no lines of progress")
    p.add_argument("--dry-run", action="store_true", help="no model, whatever --provider says")
    a = p.parse_args(argv)
    spark = SparkSession.getActiveSession() or local_session()
    cfg = SpecConfig(a.spec, a.version)
    options = Options.of(spark, rho=a.rho, max_clause_chars=a.max_clause_chars, retries=a.retries, prompt_variant=a.prompt_variant, sentinel=a.sentinel)
    provider = None if a.dry_run else _named(a.provider)
    metrics = RunMetrics(None if a.quiet else print)
    result = run(spark, a.store, a.snapshots, cfg, provider, a.label, a.log, a.resume, a.limit, a.clauses, options, a.model, examples=a.examples, embed=_named(a.embed), metrics=metrics, batch=a.batch)
    validation.by_category(result.findings).show(truncate=False)


if __name__ == "__main__":
    main()
