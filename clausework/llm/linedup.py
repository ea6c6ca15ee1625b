"""Removal of boilerplate lines that spread over many sites.

A line's spread is the number of distinct sites that it occurs on. Each line hash has a HyperLogLog sketch of its sites;
partial sketches merge by aggregation, so the shuffle has a row for each line and task at most, however often a frequent
line occurs. Only lines that occur at least as often as the threshold can spread that far. Lines whose estimate is within
``MARGIN`` of the threshold get an exact count of distinct sites; the others are decided by the estimate.

A boilerplate line stays where it stands in the document with the least doc_id, so that no text is lost from the corpus,
and goes everywhere else.

Defined results: lines are parts between line feeds, compared without white space at their ends; blank lines are never
boilerplate; null text stays null; null sites count as one site and null doc_ids come first; rows that repeat a doc_id are
alike, so a first line stays in all of them; an empty table gives an empty result; input columns named n_lines or
n_removed are replaced, all others are carried as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import maybe_broadcast, stored

MIN_SITES = 10
#: Share of the threshold on either side of it in which exact counts decide; many times the sketch's error of 1.6 %.
MARGIN = 0.15
SKETCH_BITS = 12
_FIRST = -(1 << 63)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """(k1, k2, site, doc) of every line that is not blank; k1, k2: 128 bits of hash."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("doc"), F.coalesce(F.col(site), F.lit("")).alias("site"), F.explode(F.split("text", "\n")).alias("line"))
    rows = rows.withColumn("line", _trimmed(F.col("line"))).where("line <> ''")
    return rows.select(F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"), "site", "doc")


def line_spread(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """(k1, k2, doc, sites, exact) of the lines on ``min_sites`` sites or more: hash, least doc_id, and the number of sites,
    which is exact for those near the threshold and estimated for the others."""
    lines = _lines(docs, site)
    often = lines.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("doc")).where(F.col("n") >= min_sites)
    often = stored(often, "often")
    n = often.count()
    sketches = lines.join(maybe_broadcast(often.select("k1", "k2", "doc"), n, 48).withColumnRenamed("doc", "least"), ["k1", "k2"])
    sketches = sketches.groupBy("k1", "k2").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min("least").alias("doc"))
    spread = stored(sketches.select("k1", "k2", "doc", F.hll_sketch_estimate("sketch").alias("sites")), "spread")
    low, high = min_sites * (1 - margin), min_sites * (1 + margin)
    near = spread.where((F.col("sites") >= low) & (F.col("sites") <= high))
    counted = lines.join(maybe_broadcast(near.select("k1", "k2", F.col("doc").alias("least")), n, 48), ["k1", "k2"]).groupBy("k1", "k2", "site").agg(F.min("least").alias("doc"))
    counted = counted.groupBy("k1", "k2").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("sites"))
    found = spread.where(F.col("sites") > high).select("k1", "k2", "doc", "sites", F.lit(False).alias("exact"))
    return found.unionByName(counted.where(F.col("sites") >= min_sites).select("k1", "k2", "doc", "sites", F.lit(True).alias("exact")))


def drop_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """docs with boilerplate lines gone from text, and n_lines, n_removed."""
    docs = docs.drop("n_lines", "n_removed")
    spread = stored(line_spread(docs, site, min_sites, margin), "boilerplate")
    rows = spread.count()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("doc"), "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    lines = keyed.select("doc", "t1", "t2", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", _trimmed(F.col("line"))).where("line <> ''").select("doc", "t1", "t2", "pos", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"))
    gone = lines.join(maybe_broadcast(spread.select("k1", "k2", F.col("doc").alias("least")), rows, 48), ["k1", "k2"]).where("doc <> least")
    gone = stored(gone.groupBy("doc", "t1", "t2").agg(F.collect_set("pos").alias("gone")), "gone")
    size = gone.agg(F.sum(F.size("gone") * 4 + 48)).first()[0] or 0
    kept = keyed.join(maybe_broadcast(gone, 1, int(size)), ["doc", "t1", "t2"], "left")
    parts = F.split("text", "\n")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.filter(parts, lambda line, i: ~F.array_contains("gone", i)), "\n"))
    n_lines = F.coalesce(F.when(F.col("text").isNotNull(), F.size(parts)), F.lit(0)).cast("long")
    n_removed = F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("long")
    columns = [text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return kept.select(*columns, n_lines.alias("n_lines"), n_removed.alias("n_removed"))
