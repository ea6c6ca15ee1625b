"""The corpus pipeline: low quality out, boilerplate lines out, one of each near-duplicate group, sources mixed, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. Defined results: rows with a null doc_id or a null text pass every stage as its operator defines; rows that repeat a
doc_id with one text share what the mix takes of them; very long texts are documents like others; further columns of the
input do not go beyond the first stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausework.llm import bpe, cluster, linedup, mixing, nbsvm, ngram_jaccard
from clausework.llm.queries import byte_bpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from labels of documents that are not held out."""
    labels = cluster.prepared(spark).read.parquet(f"{sf_dir}/labels.parquet").where(~nbsvm.held_out()).select("doc_id", "quality")
    scored = nbsvm.score_quality(docs, nbsvm.train_quality(docs, labels))
    return scored.where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without boilerplate lines of many sources."""
    cluster.prepared(spark)
    kept = linedup.drop_boilerplate(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of similar documents."""
    cluster.prepared(spark)
    found = ngram_jaccard.ngram_jaccard(docs.select("doc_id", "text"))
    extra = cluster.stored(found.where("component_id <> doc_id").select("doc_id").distinct(), "extra")
    return docs.join(cluster.maybe_broadcast(extra, extra.count(), 40), "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a document of several rows as often as those together."""
    cluster.prepared(spark)
    same = F.struct(F.coalesce("source", F.lit("")), F.coalesce("text", F.lit("")))
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64(same).alias("hash")).alias("key")
    mixed = mixing.mix_sources(docs.select("doc_id", "source", "text", key))
    taken = mixed.groupBy("key").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    taken = cluster.stored(taken.select("key", (F.col("copies") % F.col("rows")).alias("over"), F.floor(F.col("copies") / F.col("rows")).alias("each"), "rows"), "copies")
    joined = docs.select(*COLUMNS, key).join(cluster.maybe_broadcast(taken, taken.count(), 128), "key")
    # a row takes the even share; what is left over goes to a single row, or to one that stands for several
    alone = joined.select(*COLUMNS, F.when(F.col("rows") == 1, F.col("each") + F.col("over")).otherwise(F.col("each")).alias("copies"))
    several = joined.where("rows > 1 and over > 0").groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row"), F.first("over").alias("copies"))
    both = alone.unionByName(several.select("row.*", "copies")).where("copies > 0")
    return both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests that show that they decode to its bytes."""
    cluster.prepared(spark)
    return bpe.bpe_digests(docs.select("doc_id", "source", "text"), *byte_bpe(), keep_ids=True)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("tokens", tokens)]

#: SQL cannot express the classifier; the tests follow run() stage by stage with a plain version of each.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cluster.prepared(spark).read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = cluster.stored(stage(spark, docs, sf_dir), name)
    return docs
