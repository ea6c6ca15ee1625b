"""Trie of conversation prefixes by heavy-path decomposition.

Every distinct sequence of a conversation's first d turns is a node of depth d; the textless root has all conversations. A
turn is 128 bits of BLAKE2b of its role and text, a prefix the xor of its turns, each mixed with its place, so that running
xors name all prefixes however long a conversation is (``scan.scanned``). A node is known by its smallest member and its depth.

A node's heavy child is the one with the most members (ties: the smallest member); as another child has at most half of its
parent's members, a conversation passes at most log2(members) light edges. Heavy edges form paths; a path ends in a leaf, and
its array is the tail, after the last light node, of the turns of that leaf's smallest member. Paths hang on nodes of paths
one level up: their totals are added level by level, from the lowest up, a number of rounds that is logarithmic, and one
running sum over the path arrays, from their ends up, gives every node the sum of its subtree.

Nothing holds a whole group: members are counted by aggregation, rows of a node with very many members or children are joined
by broadcasts of bounded size, and lists of ids are hashed as a sorted stream of parts.

Defined results: null role and text become empty; turns with equal numbers are ordered by role, then text (code points), null
turns first; repeated rows are turns of their own; rows without a conv_id belong to no conversation; an empty table has no
nodes; other columns are left aside, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import stored
from .scan import joined, ranges, scanned
from .textops import mix

#: Of a conversation that is no base, at most this many first turns are replaced by the base's.
HEADS = 9
#: Ids of a sorted list in one part.
PART_IDS = 65_536
_EMPTY = hashlib.sha256(b"").hexdigest()


def _turn_hashes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """conv_id, k = 1, c1, c2 (the turn's hash), bytes (of its text)."""
    digests = bytearray()
    sizes = []
    for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
        role, text = role.encode(), text.encode()
        h = hashlib.blake2b(len(role).to_bytes(8, "little"), digest_size=16)
        h.update(role)
        h.update(text)
        digests += h.digest()
        sizes.append(len(text))
    halves = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [batch.column("conv_id"), pa.array(np.ones(len(sizes), np.int64)), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(sizes, pa.int64())], ["conv_id", "k", "c1", "c2", "bytes"]
    )


def _placed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """conv_id, d, bytes, and the turn's hash mixed with its place d."""
    d = batch.column("d").to_numpy(zero_copy_only=False).astype(np.uint64)
    own = d > 0  # the root has no turn
    halves = [np.where(own, mix(batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) ^ mix(d * np.uint64(2) + np.uint64(salt))), np.uint64(0)).view(np.int64) for salt, c in ((1, "c1"), (0x5EED5, "c2"))]
    return pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("d"), batch.column("bytes"), *map(pa.array, halves)], ["conv_id", "d", "bytes", "x1", "x2"])


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, k from 1, c1, c2, bytes): the turns of each conversation in order; texts are read once and left behind."""
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.substring("text", 1, 32).asc()]
    within = [*order[:2], F.col("text").asc()]
    return scanned(rows, ["conv_id"], order, sums=["k"], within=within, keep=["c1", "c2", "bytes"], map_rows=_turn_hashes)


def rebuilt(own: DataFrame) -> DataFrame:
    """(conv_id, d, c1, c2, bytes) of conversations whose first turns come from the one that their id's fifth names; d = 0 is the root."""
    lens = stored(own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("len")), "lens")
    n = lens.count()
    base = F.col("conv_id") - F.col("conv_id") % 5
    plan = lens.select("conv_id", "len", base.alias("base"), F.when(F.col("conv_id") == base, 0).otherwise(F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"))
    bases = lens.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    plan = plan.join(bases, "base", "left").select("conv_id", "base", "len", "h", F.least(F.col("h"), F.coalesce(F.col("base_len"), F.lit(0))).alias("from_base"))
    plan = stored(plan, "plan")
    tails = joined(own, plan.select("conv_id", "h", "from_base", "len"), ["conv_id"], F.col("len"), n).where("k > h")
    tails = tails.select("conv_id", (F.col("k") - F.col("h") + F.col("from_base")).alias("d"), "c1", "c2", "bytes")
    heads = own.where(f"k < {HEADS} and conv_id % 5 = 0").withColumnRenamed("conv_id", "base")
    heads = heads.join(plan.where("from_base > 0").select("conv_id", "base", "from_base"), "base").where("k <= from_base").select("conv_id", F.col("k").alias("d"), "c1", "c2", "bytes")
    zero = F.lit(0).cast("long")
    roots = plan.select("conv_id", zero.alias("d"), zero.alias("c1"), zero.alias("c2"), zero.alias("bytes"))
    return tails.unionByName(heads).unionByName(roots)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of nodes, in parts of a bounded number, joined by commas."""
    for batch in batches:
        m, d, conv = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("m", "d", "conv_id"))
        if not len(m):
            continue
        new = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (d[1:] != d[:-1])]))
        cuts = np.unique(np.concatenate([new, np.arange(0, len(m), PART_IDS), [len(m)]]))
        lo = cuts[:-1]
        parts = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(lo.tolist(), cuts[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(m[lo]), pa.array(d[lo]), pa.array(conv[lo]), pa.array(parts, pa.string())], ["m", "d", "first", "part"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's parts, which come in order; one part is held at a time."""
    node, digest, out = None, None, ([], [], [])

    def close():
        if node is not None:
            for column, value in zip(out, (*node, digest.hexdigest()), strict=True):
                column.append(value)

    def rows():
        made = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["m", "d", "ends_sha256"])
        for column in out:
            column.clear()
        return made

    for batch in batches:
        for m, d, part in zip(batch.column("m").to_pylist(), batch.column("d").to_pylist(), batch.column("part").to_pylist(), strict=True):
            if (m, d) != node:
                close()
                node, digest = (m, d), hashlib.sha256(part.encode())
            else:
                digest.update(b",")
                digest.update(part.encode())
        yield rows()
    close()
    yield rows()


def _ends(ends: DataFrame) -> DataFrame:
    """(m, d, ends_sha256) of (m, d, conv_id): the hash of each node's ids, numerically ascending and joined by commas."""
    longs = lambda *names: T.StructType([T.StructField(c, T.LongType()) for c in names])
    parts = ends.repartitionByRange(ranges(ends), "m", "d", "conv_id").sortWithinPartitions("m", "d", "conv_id").mapInArrow(_parts, longs("m", "d", "first").add("part", T.StringType()))
    return parts.repartition("m", "d").sortWithinPartitions("m", "d", "first").mapInArrow(_hashed, longs("m", "d").add("ends_sha256", T.StringType()))


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row for each node of the trie of (conv_id, d, c1, c2, bytes), d = 0 for the root and each conversation."""
    named = scanned(sequences, ["conv_id"], [F.col("d").asc()], xors=["x1", "x2"], keep=["d", "bytes"], map_rows=_placed)
    by_hash = stored(named.groupBy("d", "x1", "x2").agg(F.min("conv_id").alias("m"), F.count(F.lit(1)).alias("n"), F.first("bytes").alias("bytes")), "prefixes")
    n_nodes = by_hash.count()
    placed = stored(joined(named.drop("bytes"), by_hash, ["d", "x1", "x2"], F.col("n"), n_nodes).select("conv_id", "d", "m", "n", "bytes"), "members")

    # nodes by smallest member and depth, with their parents
    above = placed.select("conv_id", (F.col("d") + 1).alias("d"), F.col("m").alias("parent"))
    nodes = placed.where("conv_id = m").select("conv_id", "d", "n", "bytes").join(above, ["conv_id", "d"], "left").withColumnRenamed("conv_id", "m")
    nodes = stored(nodes.select("m", "d", "n", "parent", ((F.col("n") - 1) * F.col("bytes")).alias("saved")), "nodes")
    children = nodes.where("d > 0").groupBy(F.col("parent").alias("m"), (F.col("d") - 1).alias("d")).agg(F.count(F.lit(1)).alias("n_children"), F.min(F.struct((-F.col("n")).alias("k"), F.col("m").alias("child")))["child"].alias("heavy_child"))
    children = stored(children, "children")
    heavy = children.select(F.col("heavy_child").alias("m"), (F.col("d") + 1).alias("d"), F.lit(False).alias("light"))
    marked = nodes.join(children.select("m", "d", "n_children"), ["m", "d"], "left").join(heavy, ["m", "d"], "left")
    marked = stored(marked.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).withColumn("light", F.coalesce("light", F.lit(True))), "marked")

    # paths, named by the smallest member of the leaf where they end: their rows lead from the root to that leaf
    leaves = stored(marked.where("n_children = 0").select(F.col("m").alias("conv_id"), F.col("d").alias("depth")), "leaves")
    n_leaves = leaves.count()
    rows = joined(placed.select("conv_id", "d", "m"), leaves, ["conv_id"], F.col("depth"), n_leaves).where("d <= depth").drop("depth")
    rows = stored(joined(rows, marked.select("m", "d", "light", "n"), ["m", "d"], F.col("n"), n_nodes), "downward")
    paths = rows.where("light").groupBy("conv_id").agg(F.max("d").alias("top"), (F.count(F.lit(1)) - 1).alias("level"), F.max_by("m", "d").alias("head"))
    paths = stored(paths.join(leaves, "conv_id").withColumnRenamed("conv_id", "path"), "paths")
    arrays = joined(rows.select(F.col("conv_id").alias("path"), "d", "m"), paths.select("path", "top", "depth"), ["path"], F.col("depth"), n_leaves).where("d >= top").drop("top", "depth")
    arrays = stored(arrays.join(marked.select("m", "d", "n_children", "saved", "parent"), ["m", "d"]), "arrays")

    # a light path hangs on the node above its head; totals go up level by level
    own = arrays.groupBy("path").agg(F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.sum("saved").alias("saved"))
    heads = paths.join(arrays.select("path", F.col("d").alias("top"), F.col("parent")), ["path", "top"]).join(own, "path")
    above = arrays.select(F.col("m").alias("parent"), (F.col("d") + 1).alias("top"), F.col("path").alias("onto"), F.col("n_children").alias("heat"))
    hung = heads.where("level > 0").select("path", "parent", "top", "level", "leaves", "saved")
    hung = stored(joined(hung, above, ["parent", "top"], F.col("heat"), n_nodes).drop("heat"), "hung")
    deepest = hung.agg(F.max("level")).first()[0] or 0
    attached, carried = None, None
    for level in range(deepest, 0, -1):
        here = hung.where(F.col("level") == level)
        if carried is not None:
            here = here.join(carried, "path", "left")
            here = here.select("path", "parent", "top", "onto", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        here = stored(here.select("path", "parent", "top", "onto", "leaves", "saved"), "level")
        carried = here.groupBy(F.col("onto").alias("path")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        attached = here if attached is None else attached.unionByName(here)
    values = arrays.select("path", "m", "d", "parent", "n_children", (F.col("n_children") == 0).cast("long").alias("leaves"), "saved")
    if attached is not None:
        light = attached.groupBy(F.col("parent").alias("m"), (F.col("top") - 1).alias("d")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        values = values.join(light, ["m", "d"], "left")
        values = values.select("path", "m", "d", "parent", "n_children", *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")))
    values = values.withColumn("up", -F.col("d"))
    summed = scanned(values, ["path"], [F.col("up").asc()], sums=["leaves", "saved"], keep=["m", "d", "parent", "n_children"])

    # members that end at a node are those with no further turn
    last = placed.join(placed.select("conv_id", (F.col("d") - 1).alias("d")), ["conv_id", "d"], "left_anti").select("m", "d", "conv_id")
    done = summed.join(marked.select("m", "d", "n"), ["m", "d"]).join(_ends(last), ["m", "d"], "left")
    return done.select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, rebuilt on their bases' first turns."""
    return prefix_trie(rebuilt(turns(conversations)))
