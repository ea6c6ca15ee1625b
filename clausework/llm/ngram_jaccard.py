"""Self-join of documents on the Jaccard similarity of their word n-gram sets, down to linked components.

1. One pass gives every text its set's size, a 128-bit key of the set and ``BANDS`` band hashes of ``BAND_ROWS`` min-hashes
   each. Equal sets fold into one class, named by its least doc_id, before anything else is compared.
2. Classes that share a band hash may be similar; joined to the least class of that band they form candidate components.
   This only spares most texts the comparison: a pair at the threshold 0.75 shares no band with probability
   (1 - 0.75^4)^64 < 3e-11, and a more similar pair with less. Everything after it is exact.
3. A component of more than ``TILE_SHINGLES`` shingles is dealt again by rarity. Shingles stand in one order, rarest in the
   component first. Of two linked sets, the smaller one's n - ceil(6/7 n) + 1 first shingles (those it indexes) hold one of the
   larger one's n - ceil(0.75 n) + 1 first, as they share ceil(3/7 (a + b)) or more; only sets that do so stay together. Texts
   of one template, each with words of its own, part here: their common shingles come behind those that are indexed.
4. A component is compared in tiles of bounded size. A tile's sets stand in order of size; sets that meet by the same two
   prefixes are candidates if their sizes allow a link, and if the places of the shingle where they meet leave enough behind
   it in both. Hashed bitmaps as wide as the tile's sizes call for then bound the overlap from above by bit counts: every bit
   that only one set has costs that set an element. Pairs that pass are decided exactly on their sorted arrays, with
   integers. Pairs already connected are not compared again.
5. A component that is still above one tile is dealt to size bands of about a tile, first each for itself, then the least
   member of each part against those of other tiles, and at last those members that are not in the component's main part
   against all bands whose sizes allow a link. That decides every pair that is not connected yet, so no link between
   components is lost, and no task holds a large group.

Defined results: words are runs of bytes other than space and 0x09-0x0D, lower-cased in A-Z only; with fewer than n words
the whole sequence is the one shingle; null, empty or blank texts have the empty set and are linked with nothing; rows with
a null doc_id get their set's size and a null component and link nothing; rows that repeat a doc_id count as one document,
so their texts are linked; an empty table gives an empty result. Further columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import textops as X
from .cluster import checkpointed, connected_components, maybe_broadcast, stored

N = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, BAND_ROWS = 64, 4
TILE_SHINGLES = 1_000_000

_RNG = np.random.default_rng(0xBA9D)
_MULTIPLY = _RNG.integers(0, 1 << 31, BANDS * BAND_ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, BANDS * BAND_ROWS, dtype=np.uint32)


def band_hashes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows x BANDS) hashes of the rows' min-hashes; rows with the empty set have a value without meaning."""
    rows = len(bounds) - 1
    out = np.zeros((rows, BANDS), np.uint64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if not len(full):
        return out
    high, at = (h >> np.uint64(32)).astype(np.uint32), bounds[full]
    for b in range(BANDS):
        got = np.full(len(full), b + 1, np.uint64)
        for k in range(b * BAND_ROWS, (b + 1) * BAND_ROWS):
            got = X.mix(got + np.minimum.reduceat(high * _MULTIPLY[k] + _ADD[k], at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[full, b] = got
    return out


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = X.utf8(batch.column("text"))
            for lo, hi, part, at in X.slices(data, offsets):
                h, bounds = X.shingle_sets(part, at, n)
                keys = [X.by_row(X.mix(h ^ np.uint64(s)), bounds, np.add, 0).view(np.int64) for s in (0x1D, 0x2F5)]
                bands = band_hashes(h, bounds)
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BANDS * 8), hi - lo, [None, pa.py_buffer(bands.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(bounds)), pa.array(keys[0]), pa.array(keys[1]), raw], ["doc_id", "n_shingles", "k1", "k2", "bands"])

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            bands = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bands), pa.array(np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), BANDS))], ["bucket", "node"])


class _Parts:
    """Disjoint groups of places; ``of`` names each place's group at any time."""

    def __init__(self, labels: np.ndarray):
        _, self.of = np.unique(labels, return_inverse=True)
        by_group = np.argsort(self.of, kind="stable")
        cuts = np.flatnonzero(np.diff(self.of[by_group])) + 1
        self.members = [part.tolist() for part in np.split(by_group, cuts)]

    def join(self, a: int, b: int) -> None:
        large, small = sorted((self.of[a], self.of[b]), key=lambda g: -len(self.members[g]))
        self.of[self.members[small]] = large
        self.members[large] += self.members[small]
        self.members[small] = []


def prefix_length(size, percent: int = PERCENT):
    """How many of a set's shingles, first in any order that all sets share, must hold one of every linked set's."""
    return size - -(-percent * size // 100) + 1


def index_length(size, percent: int = PERCENT):
    """How many of a set's shingles, first in that order, must hold one that any linked set of its size or more has among
    its ``prefix_length`` first: two such sets share at least 2 t / (1 + t) of the smaller one's size."""
    return size - -(-2 * percent * size // (100 + percent)) + 1


def needed(a, b, percent: int = PERCENT):
    """The least number of common shingles of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def _postings(tokens: np.ndarray, owner: np.ndarray, size: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """(list, place, nth, indexed) of every shingle that a set has among its rarest: the lists numbered, places ascending in
    each, how many of its set stand before it, and whether it is among those that are indexed. A list begins with an indexed
    one, and has others behind it."""
    _, number, count = np.unique(tokens, return_inverse=True, return_counts=True)
    rarity = count[number]
    by_set = np.lexsort((number, rarity, owner))
    nth = np.arange(len(tokens)) - np.repeat(np.cumsum(size) - size, size)
    keep = (nth < prefix_length(size, percent)[owner]) & (rarity[by_set] > 1)
    rarest, nth = by_set[keep], nth[keep]
    order = np.lexsort((owner[rarest], number[rarest]))
    rarest, nth = rarest[order], nth[order]
    lists, place = number[rarest], owner[rarest]
    indexed = nth < index_length(size, percent)[place]
    behind = np.zeros(len(lists), bool)
    if len(lists):
        first = np.flatnonzero(np.diff(lists, prepend=-1))
        seen = np.cumsum(indexed)
        behind = seen - np.repeat(seen[first] - indexed[first], np.diff(np.append(first, len(lists)))) > 0
    lists, place, nth, indexed = (x[behind] for x in (lists, place, nth, indexed))
    shared = np.bincount(lists)[lists] > 1 if len(lists) else np.zeros(0, bool)
    return np.unique(lists[shared], return_inverse=True)[1], place[shared], nth[shared], indexed[shared]


def linked_pairs(h: np.ndarray, bounds: np.ndarray, labels: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Label pairs that connect all labels of linked sets: a spanning forest, found without comparing connected sets."""
    sizes = np.diff(bounds)
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    size = sizes[order]
    if len(order) < 2:
        return []
    owner = np.repeat(np.arange(len(order)), size)
    at = np.cumsum(size) - size
    tokens = h[np.repeat(bounds[order] - at, size) + np.arange(len(owner))]
    lists, place, nth, indexed = _postings(tokens, owner, size, percent)
    if not len(place):
        return []

    def may_link(p: np.ndarray | int, q: np.ndarray) -> np.ndarray:
        """Whether sets p and q of a list can be linked if its shingle is their first common one: by what follows it in both."""
        a, b = size[place[p]], size[place[q]]
        return (100 * a >= percent * b) & (np.minimum(a - nth[p], b - nth[q]) >= needed(a, b, percent))

    words = int(min(4096, max(128, 1 << int(2 * size[place].max() - 1).bit_length()))) // 64
    met = np.unique(place)
    row = np.zeros(len(order), np.int64)
    row[met] = np.arange(len(met))
    maps = np.zeros(len(met) * words, np.uint64)
    some = np.isin(owner, met)
    bit = tokens[some] & np.uint64(words * 64 - 1)
    np.bitwise_or.at(maps, row[owner[some]] * words + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    maps = maps.reshape(len(met), words)
    parts, out = _Parts(labels[order]), []

    def compare(i: int, others: np.ndarray) -> None:
        """Joins set i with those of the others, sizes allowing, that it is linked with."""
        small, large = np.minimum(size[i], size[others]), np.maximum(size[i], size[others])
        others = others[(100 * small >= percent * large) & (parts.of[others] != parts.of[i])]
        if not len(others):
            return
        mine, theirs = maps[row[i]], maps[row[others]]
        most = np.minimum(size[i] - np.bitwise_count(mine & ~theirs).sum(axis=1), size[others] - np.bitwise_count(theirs & ~mine).sum(axis=1))
        a = tokens[at[i] : at[i] + size[i]]
        for x in others[(100 + percent) * most >= percent * (size[i] + size[others])].tolist():
            if parts.of[x] == parts.of[i]:
                continue
            b = tokens[at[x] : at[x] + size[x]]
            near = np.searchsorted(b, a)
            both = int((b[np.minimum(near, len(b) - 1)] == a).sum())
            if 100 * both >= percent * (len(a) + len(b) - both):
                out.append((int(labels[order[i]]), int(labels[order[x]])))
                parts.join(i, x)

    first = np.flatnonzero(np.diff(lists, prepend=-1))
    # every set with the first of its lists: that connects most of what is linked
    own = np.arange(len(lists))
    behind = own[first[lists] != own]
    behind = behind[may_link(first[lists[behind]], behind)]
    stars = np.unique(place[first[lists[behind]]] * len(order) + place[behind])
    for group in np.split(stars, np.flatnonzero(np.diff(stars // len(order))) + 1):
        if len(group):
            compare(int(group[0] // len(order)), group % len(order))
    # what lists still hold of unconnected sets, each indexed one with those behind it
    of = parts.of[place]
    mixed = (np.minimum.reduceat(of, first) != np.maximum.reduceat(of, first))[lists]
    end = np.searchsorted(lists, lists, side="right")
    left = own[mixed & indexed & (end - own > 1)]
    left = left[np.argsort(place[left], kind="stable")]
    for mine in np.split(left, np.flatnonzero(np.diff(place[left])) + 1):
        if len(mine):
            i = int(place[mine[0]])
            others = []
            for p in mine.tolist():
                q = np.arange(p + 1, end[p])
                q = q[parts.of[place[q]] != parts.of[i]]
                others.append(place[q[may_link(p, q)]])
            compare(i, np.unique(np.concatenate(others)))
    return out


def _tile_links(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in X.groups(batches, "tile"):
            data, offsets = X.utf8(tile.column("text"))
            h, bounds = [], [np.zeros(1, np.int64)]
            for _, _, part, at in X.slices(data, offsets):
                got, b = X.shingle_sets(part, at, n)
                bounds.append(b[1:] + bounds[-1][-1])
                h.append(got)
            if h:
                pairs = linked_pairs(np.concatenate(h), np.concatenate(bounds), tile.column("label").to_numpy(), percent)
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

    return run


def tile_links(docs: DataFrame, tiles: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) between labels, from tiles (tile, node, label): every linked pair of a tile is connected by them."""
    held = maybe_broadcast(tiles, tiles.count(), 64)
    rows = docs.select(F.col("doc_id").alias("node"), "text").join(held, "node").select("tile", "label", "text")
    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(_tile_links(n, percent), "a long, b long")


def _shingle_rows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = X.utf8(batch.column("text"))
            for lo, hi, part, at in X.slices(data, offsets):
                h, bounds = X.shingle_sets(part, at, n)
                size = np.diff(bounds)
                one = lambda c: batch.column(c).slice(lo, hi - lo).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                key = X.by_row(X.mix(h), bounds, np.add, 0).view(np.int64)
                columns = [np.repeat(v, size) for v in (one("comp"), one("node"), key, size)]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*columns, h.view(np.int64))], ["comp", "node", "key", "size", "h"])

    return run


def rare_edges(docs: DataFrame, members: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) that connect the nodes of a component (node, comp) whose sets may be linked: of a shingle, the first node
    by size that indexes it is connected with all behind it that have it among their rarest."""
    held = maybe_broadcast(members.select("node", "comp"), members.count(), 32)
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(held, "node")
    shingles = stored(texts.select("comp", "node", "text").mapInArrow(_shingle_rows(n), "comp long, node long, key long, size long, h long"), "shingles")
    counts = shingles.groupBy("comp", "h").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    shared = shingles.join(counts, ["comp", "h"])
    one_set = W.partitionBy("node", "key")  # a window holds one set's shingles; those that no other has stand before them
    place = F.row_number().over(one_set.orderBy("sets", "h")) + F.col("size") - F.count(F.lit(1)).over(one_set)
    length = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    short = F.col("size") - F.ceil(F.col("size") * (2 * percent) / (100 + percent)) + 1
    by_size = F.struct("size", "node")
    rarest = stored(shared.withColumn("place", place).where(F.col("place") <= length).select("comp", "h", "node", by_size.alias("at"), (F.col("place") <= short).alias("indexed")), "rarest")
    least = rarest.groupBy("comp", "h").agg(F.min(F.when(F.col("indexed"), F.col("at"))).alias("b"), F.max("at").alias("most")).where("b < most").drop("most")
    return rarest.join(least, ["comp", "h"]).where("at > b").select(F.col("node").alias("a"), F.col("b.node").alias("b")).where("a <> b").distinct()


def _dealt(members: DataFrame, name: str, tile_shingles: int) -> DataFrame:
    """members (node, comp, n_shingles) with ``name``: parts of about a tile each that follow sizes."""
    sizes = members.groupBy("comp", "n_shingles").agg(F.sum("n_shingles").alias("all"))
    before = F.coalesce(F.sum("all").over(W.partitionBy("comp").orderBy("n_shingles").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("comp", "n_shingles", F.floor(before / tile_shingles).alias("from"), F.ceil(F.col("all") / tile_shingles).alias("wide"))
    return members.join(sizes, ["comp", "n_shingles"]).withColumn(name, F.col("from") + F.pmod(F.xxhash64("node", F.lit(5)), F.col("wide"))).drop("from", "wide")


def _band(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("comp", name).agg(F.min("n_shingles").alias(f"{name}_lo"), F.max("n_shingles").alias(f"{name}_hi"))


def component_links(docs: DataFrame, members: DataFrame, n: int = N, percent: int = PERCENT, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """Edges (a, b) that connect the linked nodes of candidate components (node, comp, n_shingles)."""
    parts = lambda m: m.groupBy("comp").agg(F.ceil(F.sum("n_shingles") / tile_shingles).alias("parts"))
    members = checkpointed(members.select("node", "comp", "n_shingles").join(parts(members), "comp"))
    if members.where("parts > 1").limit(1).count():
        large = members.where("parts > 1").select("node", "comp", "n_shingles")
        again = connected_components(rare_edges(docs, large, n, percent))
        again = large.drop("comp").join(again.withColumnRenamed("component", "comp"), "node")
        members = members.where("parts = 1").select("node", "comp", "n_shingles").unionByName(again.select("node", "comp", "n_shingles"))
        members = members.join(parts(members), "comp")
    members = checkpointed(_dealt(members, "block", tile_shingles))
    edges = stored(tile_links(docs, members.select(F.xxhash64("comp", "block").alias("tile"), "node", F.col("node").alias("label")), n, percent), "links")
    large = members.where("parts > 1")
    if not large.limit(1).count():
        return edges
    while True:  # parts of different tiles meet by their least members
        labels = _labels(large, edges)
        heads = labels.where("node = label").select("comp", "node", "label", "n_shingles")
        sums = heads.groupBy("comp").agg(F.ceil(F.sum("n_shingles") / tile_shingles).alias("tiles"), F.count(F.lit(1)).alias("heads"))
        before = heads.count()
        tiles = heads.join(sums.where("heads > 1"), "comp").withColumn("at", F.pmod(F.xxhash64("node", F.lit(9)), F.col("tiles")))
        found = stored(tile_links(docs, tiles.select(F.xxhash64("comp", "at").alias("tile"), "node", "label"), n, percent), "links")
        edges = edges.union(found)
        joined = found.count()
        if not joined or joined * 10 < before or tiles.agg(F.max("tiles")).first()[0] == 1:
            break
    labels = _labels(large, edges)
    weight = labels.groupBy("comp", "label").agg(F.count(F.lit(1)).alias("w"))
    main = weight.groupBy("comp").agg(F.max_by("label", F.struct("w", "label")).alias("main"))
    others = labels.join(main, "comp").where("label <> main").select("comp", "node", "label", "n_shingles")
    if not others.limit(1).count():
        return edges
    # the members outside the main part, in chunks by size, meet every block whose sizes allow a link
    others = checkpointed(_dealt(others, "chunk", tile_shingles))
    near = (F.col("block_lo") * percent <= F.col("chunk_hi") * 100) & (F.col("chunk_lo") * percent <= F.col("block_hi") * 100)
    meetings = _band(labels, "block").join(_band(others, "chunk"), "comp").where(near).select("comp", "block", "chunk")
    meetings = stored(meetings.withColumn("tile", F.xxhash64("comp", "block", "chunk")), "meetings")
    tiles = labels.join(meetings, ["comp", "block"]).select("tile", "node", "label").union(others.join(meetings, ["comp", "chunk"]).select("tile", "node", "label"))
    return edges.union(stored(tile_links(docs, tiles.distinct(), n, percent), "links"))


def _labels(members: DataFrame, edges: DataFrame) -> DataFrame:
    """members with label: the least node that the edges connect each with."""
    found = connected_components(edges).withColumnRenamed("component", "label")
    return checkpointed(members.join(found, "node", "left").withColumn("label", F.coalesce("label", "node")))


def _texts_once(docs: DataFrame, known: DataFrame) -> DataFrame:
    """docs, of a doc_id that several rows have each text once."""
    twice = stored(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"), "repeated")
    n = twice.count()
    if not n:
        return docs
    twice = maybe_broadcast(twice, n, 16)
    several = docs.join(twice, "doc_id", "left_semi").groupBy("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")).agg(F.min("text").alias("text"))
    return docs.join(twice, "doc_id", "left_anti").unionByName(stored(several.select("doc_id", "text"), "texts"))


def ngram_jaccard(docs: DataFrame, n: int = N, percent: int = PERCENT, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id long, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(docs.mapInArrow(_signatures(n), "doc_id long, n_shingles long, k1 long, k2 long, bands binary"), "signatures")
    known = signed.where("doc_id is not null and n_shingles > 0")
    classes = stored(known.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles")), "classes")
    reps = known.join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).where("doc_id = rep").select("rep", "bands")
    buckets = stored(reps, "representatives").mapInArrow(_buckets, "bucket long, node long")
    least = buckets.groupBy("bucket").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most").select("bucket", "b")
    least = stored(least, "buckets")
    edges = buckets.join(maybe_broadcast(least, least.count(), 32), "bucket").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    same_id = classes.groupBy("rep").agg(F.sum("n_shingles").alias("n_shingles"))
    members = connected_components(edges).withColumnRenamed("component", "comp").join(same_id.withColumnRenamed("rep", "node"), "node")
    links = component_links(_texts_once(docs, known), members, n, percent, tile_shingles)
    found = connected_components(links)
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    return signed.drop("bands").join(named, ["k1", "k2"], "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
