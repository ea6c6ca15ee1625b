"""Releases against releases: presence, values over time, what held when, and likely renames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.kernels import lexical_distance
from ..storage import checkpointed


def presence(observed: DataFrame, first: int, last: int) -> DataFrame:
    """(key, introduced, floor, observed, last_seen, valid_until, gaps) for rows (key, release as a number).

    floor: introduced at the earliest release there is, so a lower bound. valid_until: the last one seen, if not the latest.
    """
    seen = observed.select("key", "release").distinct().groupBy("key").agg(F.min("release").alias("introduced"), F.max("release").alias("last_seen"), F.count(F.lit(1)).alias("observed"))
    return seen.select("key", "introduced", (F.col("introduced") == first).alias("floor"), "observed", "last_seen", F.when(F.col("last_seen") < last, F.col("last_seen")).alias("valid_until"), (F.col("last_seen") - F.col("introduced") + 1 - F.col("observed")).alias("gaps"))


def segments(values: DataFrame) -> DataFrame:
    """(key, segment, value, valid_from, valid_to, observations, supersedes): runs of equal values of (key, at, value).

    valid_to is where the next run starts, null for the open one; A, B, A are three segments, each superseding the one before.
    """
    w = W.partitionBy("key").orderBy("at")
    changed = F.when(F.col("value").eqNullSafe(F.lag("value").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    runs = values.withColumn("new", changed).withColumn("segment", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    s = runs.groupBy("key", "segment").agg(F.min("value").alias("value"), F.min("at").alias("valid_from"), F.count(F.lit(1)).alias("observations"))
    n = W.partitionBy("key").orderBy("segment")
    return s.withColumns({"valid_to": F.lead("valid_from").over(n), "supersedes": F.lag("segment").over(n)})


def as_of(found: DataFrame, at) -> DataFrame:
    """The segments that hold at a point: from it included to the next excluded."""
    return found.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.lit(at) < F.col("valid_to"))))


def renames(observed: DataFrame, links: DataFrame, release: int, least: float = 0.5, about: DataFrame | None = None) -> DataFrame:
    """(gone, new, shared, overlap): keys last seen just before a release and keys first seen in it that share neighbours.

    observed (key, release); links (key, neighbour). Overlap is shared neighbours by all of both. Keys that reach ``least``
    share one of their rarest neighbours, so candidates meet through those, not through what everything is linked to, and
    are counted exactly afterwards. With ``about`` (key, type, layer, label) only keys of one type and layer meet (nulls
    are equal), and similarity (1 less the distance of their labels, null if one has none) is a further column. What comes
    out is for review: nothing is merged.
    """
    ends = observed.groupBy("key").agg(F.min("release").alias("lo"), F.max("release").alias("hi"))
    sides = ends.where((F.col("hi") == release - 1) | (F.col("lo") == release)).select("key", (F.col("lo") == release).alias("is_new"))
    if about is None:
        kind = F.lit("").alias("kind")
    else:
        sides, kind = sides.join(about.dropDuplicates(["key"]), "key"), F.to_json(F.struct("type", "layer")).alias("kind")
    sides = sides.select("key", "is_new", kind, *(["label"] if about is not None else []))
    held = checkpointed(links.select("key", "neighbour").where("neighbour is not null").distinct().join(sides, "key"))
    sizes = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shares = held.groupBy("neighbour").agg(F.count(F.lit(1)).alias("d"))
    place = F.row_number().over(W.partitionBy("key").orderBy("d", "neighbour"))
    bar = F.lit(least - 0.00005)  # overlap is rounded to four places before it is held against least
    rare = held.join(shares, "neighbour").withColumn("place", place).join(sizes, "key").where(F.col("place") <= F.col("n") - F.ceil(bar * F.col("n") - 1e-9) + 1)
    of = lambda rows, new, name, *more: rows.where(F.col("is_new") == new).select(F.col("key").alias(name), "neighbour", *more)
    pairs = of(rare, False, "gone", "kind").join(of(rare, True, "new", "kind"), ["neighbour", "kind"]).select("gone", "new").distinct()
    shared = pairs.join(of(held, False, "gone"), "gone").join(of(held, True, "new"), ["new", "neighbour"]).groupBy("gone", "new").agg(F.count(F.lit(1)).alias("shared"))
    sized = shared.join(sizes.select(F.col("key").alias("gone"), F.col("n").alias("a")), "gone").join(sizes.select(F.col("key").alias("new"), F.col("n").alias("b")), "new")
    overlap = F.col("shared").cast("double") / (F.col("a") + F.col("b") - F.col("shared"))
    found = sized.select("gone", "new", "shared", F.round(overlap, 4).alias("overlap")).where(F.col("overlap") >= least)
    if about is None:
        return found
    label = lambda new, name, to: sides.where(F.col("is_new") == new).select(F.col("key").alias(name), F.col("label").alias(to))
    named = found.join(label(False, "gone", "a"), "gone").join(label(True, "new", "b"), "new")
    return named.select("gone", "new", "shared", "overlap", F.round(1 - lexical_distance("a", "b"), 4).alias("similarity"))


def representative(versions: DataFrame) -> DataFrame:
    """(release, version): the latest version of each release, by its dotted numbers."""
    key = F.transform(F.split("version", r"\."), lambda v: v.try_cast("int"))
    return versions.withColumn("k", key).groupBy("release").agg(F.max_by("version", "k").alias("version"))


def derive(snapshots: DataFrame, lineage: str, releases: tuple[str, ...]) -> DataFrame:
    """One record for each id over all releases' snapshots (release, record columns): the latest release's fields, all
    provenance by (release, version, clause, anchor), and the lifecycle recomputed. The order of snapshots has no part in it."""
    rank = F.array_position(F.array(*[F.lit(r) for r in releases]), F.col("release"))
    rows = snapshots.withColumn("r", rank)
    items = rows.select("id", "r", F.explode(lineage).alias("p")).groupBy("id", "p.release", "p.version", "p.clause", "p.anchor").agg(F.min(F.struct("r", "p")).alias("x"))
    lists = items.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("x.r", "x.p"))).alias("l")).select("id", F.col("l.p").alias(lineage))
    seen = rows.groupBy("id").agg(F.array_sort(F.collect_set("r")).alias("rs"))
    latest = rows.withColumn("k", F.row_number().over(W.partitionBy("id").orderBy(F.desc("r"), "ord"))).where("k = 1")
    names = F.array(*[F.lit(r) for r in releases])
    life = {"observed_in": F.transform("rs", lambda i: F.get(names, i.cast("int") - 1)), "introduced_in": F.get(names, F.array_min("rs").cast("int") - 1), "valid_until": F.when(F.array_max("rs") < len(releases), F.get(names, F.array_max("rs").cast("int") - 1))}
    keep = [c for c in latest.columns if c not in (lineage, "release", "r", "k", *life)]
    return latest.select(*keep).join(seen, "id").join(lists, "id", "left").withColumns(life).drop("rs")


def normalised_set(c):
    """A comma-separated value as a sorted set in one string."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(F.split(c, ","), lambda x: F.trim(x)))), ",")


def normalised_number(c):
    """The first number of a value."""
    return F.regexp_extract(c, r"-?\d+(?:\.\d+)?", 0).try_cast("double")
