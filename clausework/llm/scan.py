"""Running values over sorted groups of any length, and joins that spread rows of a frequent key.

A group may hold a third of all rows, so no window works on a whole group: rows are dealt to ranges of (group, order), each
task keeps running values of its range, and only the sums of earlier ranges of the one group that goes on in a range, at most
one row for each range, are added afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import maybe_broadcast, stored

#: A key with more rows than this is joined by a broadcast of the other side's row, so that its rows stay where they are.
HOT_ROWS = 10_000


def ranges(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _running(values: np.ndarray, first: np.ndarray, xor: bool, start: int) -> np.ndarray:
    """Inclusive running sums or xors that begin anew where ``first`` is set; the run before the first mark goes on from start."""
    total = np.bitwise_xor.accumulate(values) if xor else np.cumsum(values)
    before = np.concatenate([[0], total[:-1]]).astype(np.int64)
    at = np.maximum.accumulate(np.where(first, np.arange(len(values)), -1))
    base = np.where(at < 0, 0, before[np.maximum(at, 0)])
    carry = np.where(at < 0, start, 0)
    return (total ^ base ^ carry) if xor else (total - base + carry)


def scanned(df: DataFrame, group: list[str], order: list[Column], sums: list[str] = [], xors: list[str] = [], within: list[Column] = [], keep: list[str] | None = None, map_rows=None) -> DataFrame:  # noqa: B006
    """df with its long columns ``sums`` and ``xors`` replaced by their running values in each group, the row itself included.

    ``group`` names long columns without nulls, possibly none. Rows are dealt by group and ``order``, and sorted by ``within``
    (default: order); ``keep`` names what the result carries beside them. ``map_rows`` turns a batch into one that has all these.
    """
    n = ranges(df)
    keys = [F.col(c) for c in group]
    sorted_rows = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *(within or order))
    keep = [c for c in df.columns if c not in (*group, *sums, *xors)] if keep is None else keep
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fields = [T.StructField(c, T.LongType()) for c in group] + [T.StructField(c, kinds.get(c, T.LongType())) for c in keep] + [T.StructField(c, T.LongType()) for c in (*sums, *xors, "range", "nth")]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, last, totals, rows = TaskContext.get().partitionId(), None, dict.fromkeys((*sums, *xors), 0), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = map_rows(batch) if map_rows else batch
            first = np.zeros(batch.num_rows, bool)
            now = []
            for c in group:
                k = batch.column(c).to_numpy(zero_copy_only=False)
                first[1:] |= k[1:] != k[:-1]
                now.append((k[0], k[-1]))
            first[0] = last is None or last != [a for a, _ in now]
            last = [b for _, b in now]
            out = {}
            for c in (*sums, *xors):
                out[c] = _running(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64), first, c in xors, totals[c])
                totals[c] = int(out[c][-1])
            out["range"], out["nth"] = np.full(batch.num_rows, place, np.int64), np.arange(rows, rows + batch.num_rows)
            rows += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(out[c]) if c in out else batch.column(c) for c in names], names)

    local = stored(sorted_rows.mapInArrow(run, T.StructType(fields)), "ranges")
    by = group or ["_all"]
    local = local if group else local.withColumn("_all", F.lit(0))
    spans = local.groupBy(*by).agg(F.min("range").alias("lo"), F.max("range").alias("hi")).where("lo < hi").select(*by)
    ends = local.join(F.broadcast(spans), by)  # at most one group goes on in each range
    ends = ends.groupBy(*by, "range").agg(F.count(F.lit(1)).alias("rows"), *(F.max_by(c, "nth").alias(f"_{c}") for c in (*sums, *xors)))
    before = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(*by, "range", *(F.sum(f"_{c}").over(before).alias(f"_{c}") for c in sums), *(F.bit_xor(f"_{c}").over(before).alias(f"_{c}") for c in xors))
    done = local.join(F.broadcast(offsets), [*by, "range"], "left")
    new = [(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in sums] + [F.col(c).bitwiseXOR(F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in xors]
    return done.select(*group, *keep, *new)


def joined(many: DataFrame, one: DataFrame, key: list[str], heat: Column, rows: int, row_bytes: int = 64, how: str = "inner") -> DataFrame:
    """``many`` joined to the row of ``one`` that has its key, which is unique there and whose columns are named apart.

    A small ``one`` (its counted ``rows``) is broadcast. Of a larger one, only the keys with ``heat`` above ``HOT_ROWS`` or
    a 100,000th of all are (at most 100,000 of them, heat being how often a key stands in ``many``); the others are joined by a shuffle.
    """
    whole = maybe_broadcast(one, rows, row_bytes)
    if whole is not one:
        return many.join(whole, key, how)
    total = one.agg(F.sum(heat.cast("double"))).first()[0] or 0
    hot = F.coalesce(heat > max(HOT_ROWS, total / 100_000), F.lit(False))
    keys = F.broadcast(one.where(hot).select(*key, F.lit(True).alias("_hot")))
    marked = many.join(keys, key, "left")
    return marked.where("_hot").drop("_hot").join(F.broadcast(one.where(hot)), key, how).unionByName(marked.where("_hot is null").drop("_hot").join(one.where(~hot), key, how))
