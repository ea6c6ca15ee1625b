"""Mixing sources to target weights: capped water-filling of a word budget, then seeded repetitions of whole documents.

Every source asks for its weight's share of the budget. Sources that would pass ``max_epochs`` times their size are clamped
there, and what they leave is shared among the others by weight, again and again until none passes its stop: a few
aggregations over the table of sources, which has a row for each source and is never ordered as a whole (sources get their
places by ranges of names).

A document is repeated floor(rate) times, and a seeded draw decides about one more. Within a source, documents stand by size
class (eighths to quarters of a doubling), inside a class in seeded order, and the k-th gets
floor(rate * k + u) - floor(rate * (k - 1) + u) repetitions, u being the source's seeded start: a systematic sample with a
random start, whose words stay near the target however sizes are spread. Another seed gives other starts and orders.
Documents above a hundredth of their source go first; the rate of all others absorbs what those leave. Places come from
counts of (source, class) and (source, class, salt) and row numbers inside those, so that neither a large source nor a
large group of equal documents meets in one task.

All of it is DataFrame operations. Defined results: null text has size 0; a null source is a source of its own, last in
order; rows with a null doc_id stand in the order of their texts' digests; repeated rows are documents of their own; sources
of size 0 take nothing; a very long text is one document above a hundredth; an empty table gives an empty result; input
columns with the names of new ones are replaced, others are carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cluster import maybe_broadcast, stored

WORD = r"[^\x20\x09-\x0D]+"
NEW = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _placed(sources: DataFrame) -> DataFrame:
    """sources with n, their place from 0 in code point order, null last: ranges of names, then row numbers inside each."""
    ranges = stored(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()), "sources")
    counts = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row for each partition
    inner = F.row_number().over(W.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1
    return ranges.withColumn("inner", inner).join(counts.select("range", before.alias("before")), "range").withColumn("n", F.col("before") + F.col("inner")).drop("range", "before", "inner")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """(source, source_size, target) for rows (source, size): targets sum to ``budget`` times all sizes, as far as stops allow.

    ``weights`` go to sources in code point order, null last, repeating. The water level only rises, so each round's clamped
    sources include those of the round before, and the rounds end when none joins them.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    sources = stored(_placed(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumn("weight", w), "weights")
    stop = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > stop
        sums = sources.agg(F.sum("source_size").alias("all"), F.count_if(over).alias("n"), F.sum(F.when(over, stop)).alias("stops"), F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if sums["n"] == clamped or not sums["open"]:
            break
        clamped, level = sums["n"], (float(sums["all"]) * budget - (sums["stops"] or 0.0)) / sums["open"]
    target = F.least(F.col("weight") * F.lit(level), stop) if sums["open"] else stop
    return sources.select("source", "source_size", target.cast("double").alias("target"))


def _repetitions(rate: Column, k: Column, start: Column) -> Column:
    return (F.floor(rate * k + start) - F.floor(rate * (k - 1) + start)).cast("long")


def _size_class(size: Column) -> Column:
    """Four classes to each doubling, from the three leading bits; whole numbers only."""
    bits = F.length(F.bin(size))
    return (bits * 8 + F.floor(size * 8 / F.pow(F.lit(2.0), bits))).cast("long")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, max_epochs: float = 2.0, seed: str = "mix") -> DataFrame:
    """docs without its text, with size, source_size, target, copies (repetitions) and taken (words of all repetitions)."""
    docs = docs.drop(*NEW)
    rest = [c for c in docs.columns if c != "text"]
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit("")))))))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # null as a value, so that all joins are plain
    rows = docs.select(F.struct(*rest).alias("row"), "source", key.alias("key"), word_count(F.col("text")).alias("size"), digest.alias("digest"), F.substring(digest, 1, 2).alias("salt"))
    rows = stored(rows.withColumn("class", _size_class(F.col("size"))), "sizes")
    targets = source_targets(rows, weights, budget, max_epochs)
    start = F.conv(F.substring(F.md5(F.concat(F.lit(seed + " start "), key)), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    targets = stored(targets.select(key.alias("key"), "source_size", "target", start.alias("start")), "targets")
    bytes_ = targets.agg(F.count(F.lit(1)) * 96 + F.sum(F.octet_length("key"))).first()[0] or 0
    rows = rows.join(maybe_broadcast(targets, 1, int(bytes_)), "key")
    order = [F.desc("class"), "digest", F.desc("size")]
    large = rows.where(F.col("size") * 100 > F.col("source_size"))  # at most a hundred of each source
    large = large.withColumn("copies", _repetitions(F.col("target") / F.col("source_size"), F.row_number().over(W.partitionBy("key").orderBy(*order)), F.col("start")))
    small = rows.where(F.col("size") * 100 <= F.col("source_size"))
    counts = stored(small.groupBy("key", "class", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "counts")
    classes = counts.groupBy("key", "class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    upto = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    done = large.groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("done"))
    classes = classes.select("key", "class", upto(W.partitionBy("key").orderBy(F.desc("class"))).alias("above"), F.sum("words").over(W.partitionBy("key")).alias("words")).join(done, "key", "left")
    salts = counts.select("key", "class", "salt", upto(W.partitionBy("key", "class").orderBy("salt")).alias("beside"))
    places = salts.join(classes, ["key", "class"]).select("key", "class", "salt", (F.col("above") + F.col("beside")).alias("before"), "words", F.coalesce("done", F.lit(0)).alias("done"))
    inner = F.row_number().over(W.partitionBy("key", "class", "salt").orderBy("digest", F.desc("size")))
    small = small.withColumn("k", inner).join(places, ["key", "class", "salt"])
    # greatest and least skip nulls, so a source without words is told apart first
    rate = F.when(F.col("words") > 0, F.lit(1.0)) * F.greatest(F.lit(0.0), F.least(F.lit(float(max_epochs)), F.try_divide(F.col("target") - F.col("done"), F.col("words"))))
    small = small.withColumn("copies", F.coalesce(_repetitions(rate, F.col("before") + F.col("k"), F.col("start")), F.lit(0)))
    out = ["row", "size", "source_size", "target", "copies"]
    both = large.select(*out).unionByName(small.select(*out))
    return both.select(*[F.col("row").getField(c).alias(c) for c in rest], *out[1:], (F.col("copies") * F.col("size")).alias("taken"))
