"""Command lines that make what runs read: a clause store from a word-processor file, and curated layers as a committed run.

    spark-submit builds.py store --word FILE.docx --out DIR --spec "TS 38.331" --version 19.2.0
    spark-submit builds.py layers --items I.json --concepts C.json --facts F.json --layer KEY --snapshots DIR --spec ... --version ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus, curated, graphs, validation
from ..schema import RELEASES, Ontology, SpecConfig
from ..sources import documents, stores
from ..storage import checkpointed

ITEMS = "ord long, key string, type string, label string, clause string"
CONCEPTS = "ord long, key string, type string, label string, broader string"
FACTS = "ord long, src string, dst string, type string, modality string, confidence string, clause string, procedure string, attrs string, quote string"


def build_store(spark: SparkSession, word: str, out: str, cfg: SpecConfig) -> DataFrame:
    """The clauses of one word-processor file, written as a store of its specification and version."""
    blocks = checkpointed(documents.read_word(spark, word))
    names = [r.doc_id for r in blocks.select("doc_id").distinct().limit(2).collect()]
    if len(names) != 1:
        raise ValueError(f"{'no' if not names else 'more than one'} word-processor file at {word}: a store is made of one")
    clauses = corpus.fold_clauses(blocks, F.lit(cfg.spec), F.lit(cfg.version)).withColumn("doc_id", F.lit(cfg.store_name))
    stores.write_store(clauses, out)
    return stores.read_store(spark, out)


def build_layers(spark: SparkSession, items: DataFrame, concepts: DataFrame, facts: DataFrame, layer: str, snapshots: str, cfg: SpecConfig, label: str = "gold", releases: tuple[str, ...] = RELEASES) -> DataFrame:
    """The curated graph, with its findings, committed as a run; (concept, label, depth, entities) of its layers."""
    entities, relations = (checkpointed(x) for x in curated.curated_graph(items, concepts, facts, releases, layer, cfg))
    found = checkpointed(validation.findings(entities, relations, Ontology()))
    stores.Snapshots(spark, snapshots).commit({"entities": entities, "relations": relations, "findings": found}, cfg, label)
    depth = graphs.depths(concepts.select(F.col("key").alias("node"), F.col("broader").alias("parent")))
    known = curated.concept_scheme(concepts, depth)
    ids = known.select("label", "type", "depth").join(entities.select(F.col("id").alias("concept"), "label", "type"), ["label", "type"])
    counts = graphs.layer_counts(entities, relations)
    return ids.join(counts, "concept", "left").select("concept", "label", "depth", F.coalesce("entities", F.lit(0).cast("long")).alias("entities"))


def main(argv: list[str] | None = None) -> None:
    from ..session import local_session

    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("what", choices=("store", "layers"))
    for name in ("--spec", "--version"):
        p.add_argument(name, required=True)
    for name in ("--word", "--out", "--items", "--concepts", "--facts", "--layer", "--snapshots"):
        p.add_argument(name)
    p.add_argument("--label", default="gold", help="the run that layers are committed as")
    a = p.parse_args(argv)
    needed = ("word", "out") if a.what == "store" else ("items", "concepts", "facts", "layer", "snapshots")
    lacking = [f"--{n}" for n in needed if not getattr(a, n)]
    if lacking:
        p.error(f"{a.what} needs {', '.join(lacking)}")
    spark, cfg = SparkSession.getActiveSession() or local_session(), SpecConfig(a.spec, a.version)
    if a.what == "store":
        stores.store_summary(build_store(spark, a.word, a.out, cfg)).show(truncate=False)
    else:
        read = lambda path, schema: spark.read.schema(schema).json(path, multiLine=True)
        build_layers(spark, read(a.items, ITEMS), read(a.concepts, CONCEPTS), read(a.facts, FACTS), a.layer, a.snapshots, cfg, a.label).orderBy("depth", "concept").show(truncate=False)


if __name__ == "__main__":
    main()
