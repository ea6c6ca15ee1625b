"""The nearest label or vector of many, exactly: labels with few comparisons, vectors as products of blocks.

What two labels have in common is at most their common characters: the sum, over characters, of the smaller count bounds the
matching ratio from above, and so the distance from below. A label's candidates are tried in order of that bound until it
passes the best distance found; the rest cannot be nearer. Bounds come from counts in arrays; only what is tried is compared.

Distinct labels of a type are dealt to blocks of bounded size and looked up block by block; the best of all blocks is an
aggregation. No task holds more than a block of either side.

Vectors of a type are dealt to blocks the same way, equal ones of the canonicals' side once. A block's cosines are a product of
matrices; what is within its rounding of a row's best is then computed term by term, so that sums do not depend on the blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.kernels import CONTAINED, label_distance

#: Labels of a block, of either side, about.
BLOCK = 20_000
#: Characters are counted in so many classes; sharing one only makes a bound weaker.
CLASSES = 64
#: Numbers in the vectors of a block, about, and cosines that are held at once.
BLOCK_NUMBERS, TILE = 1 << 21, 1 << 21


def counts(labels: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(labels x CLASSES) numbers of their lower-cased characters, and their lengths."""
    low = [x.lower() for x in labels]
    sizes = np.array([len(x) for x in low], np.int64)
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32) % CLASSES
    out = np.zeros(len(low) * CLASSES, np.int64)
    np.add.at(out, np.repeat(np.arange(len(low)), sizes) * CLASSES + points, 1)
    return out.reshape(len(low), CLASSES).astype(np.int32), sizes


class Block:
    """Labels to be found, in order: of equally near ones the first is taken."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        self.counts, self.sizes = counts(labels)
        self.tried = 0

    def bounds(self, own: np.ndarray, size: int, among: np.ndarray) -> np.ndarray:
        """The least distance that each label can have; one whose shorter side may be a word of the longer counts as such."""
        common = np.minimum(self.counts[among], own).sum(axis=1)
        both = self.sizes[among] + size
        least = 1.0 - np.where(both > 0, 2.0 * common / np.maximum(both, 1), 1.0)
        return np.where(common >= np.minimum(self.sizes[among], size), np.minimum(least, CONTAINED), least)

    def nearest(self, label: str, own: np.ndarray, size: int) -> tuple[float, int]:
        """(distance, place) of the nearest label."""
        best, place = np.inf, -1
        bound = self.bounds(own, size, np.arange(len(self.labels)))
        for i in np.argsort(bound, kind="stable").tolist():
            if bound[i] > best:
                break
            self.tried += 1
            distance = label_distance(label, self.labels[i])
            if (distance, i) < (best, place) or place < 0:
                best, place = distance, i
        return best, place


def _look_up(surfaces: pd.DataFrame, canonicals: pd.DataFrame) -> pd.DataFrame:
    if not len(surfaces) or not len(canonicals):
        return pd.DataFrame({"surface_type": [], "surface_label": [], "distance": [], "ord": [], "id": [], "label": [], "type": []})
    canonicals = canonicals.sort_values(["ord", "id"], kind="stable")
    block = Block(canonicals["label"].tolist())
    own, sizes = counts(surfaces["surface_label"].tolist())
    found = [block.nearest(*x) for x in zip(surfaces["surface_label"], own, sizes.tolist(), strict=True)]
    rows = canonicals.iloc[[place for _, place in found]]
    return pd.DataFrame({"surface_type": surfaces["surface_type"].to_numpy(), "surface_label": surfaces["surface_label"].to_numpy(), "distance": [d for d, _ in found], "ord": rows["ord"].to_numpy(), "id": rows["id"].to_numpy(), "label": rows["label"].to_numpy(), "type": rows["ctype"].to_numpy()})


def nearest_labels(surfaces: DataFrame, canonicals: DataFrame, compatible: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each surface (ord, id, label, type) its nearest canonical of a compatible type (a, b) by label distance, the first
    of equals by ord, then id. Rows without a label take no part."""
    c = canonicals.where("label is not null").groupBy(F.col("type").alias("ctype"), "label").agg(F.min(F.struct(F.col("ord").cast("long").alias("ord"), F.col("id").cast("string").alias("id"))).alias("k")).select("ctype", "label", "k.ord", "k.id")
    s = surfaces.where("label is not null").select(F.col("type").alias("surface_type"), F.col("label").alias("surface_label")).distinct()
    s = s.join(F.broadcast(compatible.select(F.col("a").alias("surface_type"), F.col("b").alias("ctype"))), "surface_type")
    size = lambda df, name: df.groupBy("ctype").agg(F.ceil(F.count(F.lit(1)) / block).alias(name))
    parts = F.broadcast(size(c, "blocks").join(size(s, "salts"), "ctype"))  # a row for each type
    deal = lambda *by: F.pmod(F.xxhash64(*by), F.col("salts" if by[0].startswith("surface") else "blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    c = c.join(parts, "ctype").withColumn("block", deal("label")).withColumn("salt", every("salts")).drop("blocks", "salts")
    s = s.join(parts, "ctype").withColumn("salt", deal("surface_label")).withColumn("block", every("blocks")).drop("blocks", "salts")
    shape = "surface_type string, surface_label string, distance double, ord long, id string, label string, type string"
    keys = ["ctype", "block", "salt"]
    found = s.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(_look_up, shape)
    best = found.groupBy("surface_type", "surface_label").agg(F.min(F.struct("distance", "ord", "id", "label", "type")).alias("c"))
    out = surfaces.select(F.col("ord").alias("surface_ord"), F.col("id").alias("surface_id"), F.col("label").alias("surface_label"), F.col("type").alias("surface_type")).join(best, ["surface_type", "surface_label"])
    return out.select("surface_ord", "surface_id", "surface_label", "surface_type", F.col("c.id").alias("canonical_id"), F.col("c.label").alias("canonical_label"), F.col("c.type").alias("canonical_type"), F.col("c.distance").alias("exact"))


def _vectors(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(places, matrix) of a column's vectors; those that are null, or of which a number is null or not finite, are in neither."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    lengths = lists.value_lengths().fill_null(0).to_numpy()
    size = int(lengths.max(initial=0))
    if (odd := lengths[lists.is_valid().to_numpy(zero_copy_only=False)]).size and odd.min() != size:
        raise ValueError(f"vectors of {odd.min()} and of {size} numbers")
    rows = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
    matrix = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(rows), size)
    good = np.isfinite(matrix).all(axis=1)
    return rows[good], matrix[good]


def _sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The products of each row, added one after the other."""
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        total += x[:, i] * y[:, i]
    return total


def cosine_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """1 - cosine of each row of two matrices, from 0 to 2; 1 if one has no length."""
    norms = np.sqrt(_sums(x, x) * _sums(y, y))
    return np.where(norms == 0, 1.0, 1.0 - np.clip(_sums(x, y) / np.where(norms == 0, 1.0, norms), -1.0, 1.0))


def nearest_rows(x: np.ndarray, y: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """(places, distances): for each row of x the nearest row of y, the first of equals."""
    unit = lambda m: m / np.where((n := np.sqrt((m * m).sum(axis=1, keepdims=True))) == 0, 1.0, n)
    to, slack = np.ascontiguousarray(unit(y).T), 8 * (x.shape[1] + 8) * np.finfo(float).eps
    places, distances = np.zeros(len(x), np.int64), np.zeros(len(x))
    step = max(1, tile // max(1, len(y)))
    for lo in range(0, len(x), step):
        part = x[lo : lo + step]
        cosines = unit(part) @ to
        at, among = np.nonzero(cosines >= cosines.max(axis=1, keepdims=True) - slack)
        exact = cosine_distances(part[at], y[among])
        order = np.lexsort((among, exact, at))
        first = order[np.flatnonzero(np.diff(at[order], prepend=-1))]
        places[lo : lo + step], distances[lo : lo + step] = among[first], exact[first]
    return places, distances


def nearest_vectors(surfaces: DataFrame, canonicals: DataFrame, compatible: DataFrame, value: str = "vector", numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """For each surface (ord, id, label, type, value) its nearest canonical of a compatible type (a, b) by the cosine of their
    vectors, the first of equals by ord, then id.

    A vector that is null, or of which a number is null or not finite, has no distance (null), and comes behind all others;
    vectors of different sizes are an error.
    """
    names = ("ord", "id", "label", "type")
    c = canonicals.groupBy(F.col("type").alias("canonical_type"), F.col(value).cast("array<double>").alias("canonical_value")).agg(F.min(F.struct("ord", "id", "label")).alias("k"))
    c = c.select("canonical_type", "canonical_value", *(F.col(f"k.{n}").alias(f"canonical_{n}") for n in names[:3]))
    s = surfaces.select(*(F.col(n).alias(f"surface_{n}") for n in names), F.col(value).cast("array<double>").alias("surface_value"))
    s = s.join(F.broadcast(compatible.select(F.col("a").alias("surface_type"), F.col("b").alias("canonical_type"))), "surface_type")
    size = lambda df, side, name: df.groupBy("canonical_type").agg(F.greatest(F.ceil(F.sum(F.coalesce(F.size(f"{side}_value"), F.lit(1))) / numbers), F.lit(1)).alias(name))
    parts = F.broadcast(size(c, "canonical", "blocks").join(size(s, "surface", "salts"), "canonical_type"))  # a row for each type
    deal = lambda by, n: F.pmod(F.xxhash64(*by), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    c = c.join(parts, "canonical_type").withColumn("block", deal(["canonical_ord", "canonical_id"], "blocks")).withColumn("salt", every("salts")).drop("blocks", "salts")
    s = s.join(parts, "canonical_type").withColumn("salt", deal(["surface_ord", "surface_id"], "salts")).withColumn("block", every("blocks")).drop("blocks", "salts")
    left, right = [f"surface_{n}" for n in names], ["canonical_ord", "canonical_id", "canonical_label", "canonical_type"]
    shape = T.StructType([*(s.schema[n] for n in left), *(c.schema[n] for n in right), T.StructField("exact", T.DoubleType())])
    arrow = to_arrow_schema(shape)

    def look_up(own: pa.Table, among: pa.Table) -> pa.Table:
        if not own.num_rows or not among.num_rows:
            return arrow.empty_table()
        among = among.sort_by([("canonical_ord", "ascending"), ("canonical_id", "ascending")])
        (rows, x), (known, y) = _vectors(own["surface_value"]), _vectors(among["canonical_value"])
        places, exact = np.zeros(own.num_rows, np.int64), np.full(own.num_rows, np.nan)
        if len(rows) and len(known):
            if x.shape[1] != y.shape[1]:
                raise ValueError(f"vectors of {x.shape[1]} and of {y.shape[1]} numbers")
            found, exact[rows] = nearest_rows(x, y)
            places[rows] = known[found]
        taken = among.take(pa.array(places))
        columns = [*(own[n] for n in left), *(taken[n] for n in right), pa.array(exact, pa.float64(), from_pandas=True)]
        return pa.Table.from_arrays(columns, names=shape.names).cast(arrow)

    keys = ["canonical_type", "block", "salt"]
    found = s.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(look_up, shape)
    known = F.struct(F.col("exact").isNull().alias("none"), "exact", "canonical_ord", "canonical_id", "canonical_label", "canonical_type")
    best = found.groupBy(*left).agg(F.min(known).alias("c"))
    return best.select(*left, "c.canonical_id", "c.canonical_label", "c.canonical_type", "c.exact")
