"""Exact top-k inner products over a bit-sliced index of quantised vectors.

Components become floor(scale * x). The index packs rows into blocks; for every dimension a block keeps one bitmap over its
rows for each bit of (component - least component), and its row ids. A query's scores are never computed row by row: for
each set bit of each query component the dimension's slices are added at that bit's weight, with full adders on whole
bitmaps (negative components add complemented slices, and a constant per query makes up for it), until one bitmap is left
for each binary digit of the score. Top rows are then taken from the most significant digit downward; rows that tie at the
boundary have equal scores in every digit, and the smaller ids win. Blocks give their own top k; the best k of those are
the result, exactly.

Rows with a component beyond +-2^24 after scaling would widen every slice of their block, so they stand in blocks of their
own, unsliced, and are scored as they are, in whole numbers of any size.

Repeated rows are removed by an aggregation before blocks are packed; the index is one narrow pass over what is left.
Queries, a stated set, meet it in cells of a grid: blocks are dealt to groups and chunks of queries to parts, as many as their
numbers need, so that a cell has a few of each; a block goes once to each part and a chunk once to each group.

Defined results: rows with a null id, a null vector or null or non-finite components take no part; queries meet only rows of
their own dimension; rows with the query's id are its own; rows with equal ids and equal quantised vectors count once; a
score among a block's best that no long can hold is an error; an empty table gives an empty result. Further columns are not
carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cluster import stored

BLOCK_ROWS = 8192
CHUNK_QUERIES = 256
#: Blocks and chunks of queries that meet in one cell.
CELL_BLOCKS, CELL_CHUNKS = 4, 64
SCALE = 256.0
#: Components up to this size are sliced.
LARGEST = 1 << 24


def _rows(vectors: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """Distinct (id, vector) with components floor(scale * x), as doubles; from 2^53 doubles are whole as they are."""
    scaled = lambda x: x * F.lit(float(scale))
    whole = lambda x: F.when(F.abs(scaled(x)) < float(1 << 53), F.floor(scaled(x)).cast("double")).otherwise(scaled(x))
    finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.forall("vector", finite))
    return rows.select("id", F.transform("vector", whole).alias("vector")).distinct()


def quantised(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, rows x dimension) of a batch's rows, by dimension: integers up to LARGEST, and whole doubles of rows beyond it."""
    vectors = batch.column("vector")
    if not len(vectors):
        return
    lengths = np.array([-1 if v is None else v for v in pa.compute.list_value_length(vectors).to_pylist()])
    ids = batch.column("id")
    known = np.array(ids.is_valid())
    for d in np.unique(lengths[lengths > 0]):
        some = np.flatnonzero((lengths == d) & known)
        if not len(some):
            continue
        flat = vectors.take(pa.array(some)).flatten()
        x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(some), d)
        if not np.isfinite(x).all():
            raise OverflowError("a component is beyond doubles after scaling")
        some = ids.take(pa.array(some)).to_numpy()
        wide = (np.abs(x) > LARGEST).any(axis=1)
        if not wide.all():
            yield some[~wide], x[~wide].astype(np.int64)
        if wide.any():
            yield some[wide], x[wide]


def _integers(x: np.ndarray) -> np.ndarray:
    """Whole doubles as integers of any size."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def slices_of(x: np.ndarray) -> tuple[np.ndarray, int]:
    """(dimension x width x words bitmaps, least component) of rows x dimension integers."""
    least = int(x.min())
    y = (x - least).T
    width = max(1, int(y.max()).bit_length())
    words = -(-x.shape[0] // 64)
    padded = np.zeros((y.shape[0], words * 64), np.int64)
    padded[:, : y.shape[1]] = y
    out = np.empty((y.shape[0], width, words), np.uint64)
    for s in range(width):
        out[:, s] = np.packbits((padded >> s & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
    return out, least


def added(slices: np.ndarray, query: np.ndarray) -> np.ndarray:
    """(digits x words) bitmaps of sum |q| * (component, or its complement where q < 0), least significant digit first."""
    _, width, words = slices.shape
    size = np.abs(query)
    top = int(size.max()).bit_length()
    flip = np.where(query < 0, ~np.uint64(0), np.uint64(0))
    digits, carried, c = [], np.zeros((0, words), np.uint64), 0
    while c < width + top - 1 or len(carried):
        stack = [carried]
        for s in range(max(0, c - top + 1), min(width, c + 1)):
            d = np.flatnonzero(size >> (c - s) & 1)
            if len(d):
                stack.append(slices[d, s] ^ flip[d, None])
        rows = np.concatenate(stack) if len(stack) > 1 else carried
        onward = []
        while len(rows) > 1:
            if len(rows) == 2:
                onward.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
                break
            n = len(rows) // 3
            x, y, z = rows[:n], rows[n : 2 * n], rows[2 * n : 3 * n]
            either = x ^ y
            onward.append((x & y) | (either & z))
            rows = np.concatenate([either ^ z, rows[3 * n :]])
        digits.append(rows[0] if len(rows) else np.zeros(words, np.uint64))
        carried = np.concatenate(onward) if onward else np.zeros((0, words), np.uint64)
        c += 1
    return np.stack(digits) if digits else np.zeros((1, words), np.uint64)


def members(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(digits: np.ndarray, rows: np.ndarray, k: int, ids: np.ndarray) -> np.ndarray:
    """The k rows of the bitmap ``rows`` with the highest digits, ties to smaller ids."""
    sure, maybe = np.zeros_like(rows), rows.copy()
    for digit in digits[::-1]:
        both = sure | (maybe & digit)
        n = int(np.bitwise_count(both).sum())
        if n > k:
            maybe &= digit
        elif n < k:
            sure, maybe = both, maybe & ~digit
        else:
            sure, maybe = both, np.zeros_like(rows)
            break
    first = members(sure)
    tied = members(maybe)
    tied = tied[np.argsort(ids[tied], kind="stable")][: k - len(first)]
    return np.concatenate([first, tied])


def _index(block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list] = {}

        def block(d: int, parts: list) -> pa.RecordBatch:
            ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            wide = x.dtype == np.float64
            slices, least = (x, 0) if wide else slices_of(x)
            names = ["dim", "n", "width", "least", "ids", "slices"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((d, pa.int32()), (len(ids), pa.int32()), (0 if wide else slices.shape[1], pa.int32()), (least, pa.int64()), (ids.astype(np.int64).tobytes(), pa.binary()), (slices.tobytes(), pa.binary()))], names)

        for batch in batches:
            for ids, x in quantised(batch):
                d, wide = key = x.shape[1], x.dtype == np.float64
                size = max(1, block_rows // 8) if wide else block_rows
                held.setdefault(key, []).append((ids, x))
                while sum(len(p[0]) for p in held[key]) >= size:
                    ids, x = (np.concatenate([p[i] for p in held[key]]) for i in (0, 1))
                    yield block(d, [(ids[:size], x[:size])])
                    held[key] = [(ids[size:], x[size:])]
        for (d, _), parts in held.items():
            if sum(len(p[0]) for p in parts):
                yield block(d, parts)

    return run


def bit_sliced_index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: float = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks (dim, n, width, least, ids, slices) over every distinct sound row; width 0: unsliced doubles."""
    rows = _rows(vectors, vec_id, vector, scale).coalesce(_parts(vectors))
    return rows.mapInArrow(_index(block_rows), "dim int, n int, width int, least long, ids binary, slices binary")


def _chunks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in quantised(batch):
                for lo in range(0, len(ids), size):
                    part = [pa.array([x.shape[1]], pa.int32()), pa.array([x.dtype == np.float64]), pa.array([ids[lo : lo + size].astype(np.int64).tobytes()], pa.binary()), pa.array([x[lo : lo + size].tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(part, ["dim", "wide", "query_ids", "queries"])

    return run


def _as_long(scores: list[int]) -> np.ndarray:
    if any(not -(1 << 63) <= v < 1 << 63 for v in scores):
        raise OverflowError("a score is beyond 64 bits")
    return np.array(scores, np.int64)


def _sliced(row: dict, k: int):
    """Function of (query id, query): the places and scores of a sliced block's best rows."""
    n, ids = row["n"], np.frombuffer(row["ids"], np.int64)
    slices = np.frombuffer(row["slices"], np.uint64).reshape(row["dim"], row["width"], -1)
    every = np.zeros(slices.shape[2] * 64, np.uint8)
    every[:n] = 1

    def best_of(q: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        digits = added(slices, x)
        rows = every.copy()
        rows[:n][ids == q] = 0
        best = top_rows(digits, np.packbits(rows, bitorder="little").view(np.uint64), k, ids)
        bits = digits[:, best >> 6] >> (best & 63).astype(np.uint64) & np.uint64(1)
        constant = row["least"] * int(x.sum()) - int(-x[x < 0].sum()) * ((1 << row["width"]) - 1)
        if len(digits) < 62 and abs(constant) < 1 << 62:
            return best, (bits.astype(np.int64) << np.arange(len(digits))[:, None]).sum(axis=0) + constant
        return best, _as_long([sum(int(b) << i for i, b in enumerate(column)) + constant for column in bits.T])

    return best_of


def _unsliced(row: dict, k: int):
    """The same for a block of rows beyond LARGEST."""
    ids = np.frombuffer(row["ids"], np.int64)
    stored_rows = np.frombuffer(row["slices"], np.float64).reshape(row["n"], row["dim"])
    largest = int(np.abs(stored_rows).max())
    short = stored_rows.astype(np.int64) if largest < 1 << 62 else None
    exact: list[np.ndarray] = []

    def best_of(q: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if short is not None and largest * int(np.abs(x).sum()) < 1 << 62:
            scores = short @ x.astype(np.int64)
        else:
            if not exact:
                exact.append(_integers(stored_rows))
            scores = exact[0] @ x.astype(object)
        others = np.flatnonzero(ids != q)
        best = np.array(sorted(others.tolist(), key=lambda i: (-int(scores[i]), ids[i]))[:k], np.int64)
        return best, _as_long([int(scores[i]) for i in best])

    return best_of


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                queries = np.frombuffer(row["queries"], np.float64 if row["wide"] else np.int64).reshape(-1, row["dim"])
                best_of = _sliced(row, k) if row["width"] else _unsliced(row, k)
                out: tuple[list, list, list] = ([], [], [])
                for q, x in zip(np.frombuffer(row["query_ids"], np.int64), _integers(queries) if row["wide"] else queries, strict=True):
                    best, score = best_of(q, x)
                    out[0].append(np.full(len(best), q))
                    out[1].append(ids[best])
                    out[2].append(score)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: float = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with all other rows."""
    blocks = stored(bit_sliced_index(vectors, vec_id, vector, scale, block_rows), "slices")
    wanted = _rows(vectors.where(is_query), vec_id, vector, scale)
    chunks = wanted.coalesce(_parts(vectors)).mapInArrow(_chunks(CHUNK_QUERIES), "dim int, wide boolean, query_ids binary, queries binary")
    chunks = stored(chunks, "query_chunks")
    groups, parts = _cells(blocks.count(), chunks.count(), _parts(vectors))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = blocks.withColumn("at", F.pmod(F.xxhash64("ids"), F.lit(groups))).withColumn("part", every(parts))
    chunks = chunks.withColumn("part", F.pmod(F.xxhash64("query_ids"), F.lit(parts))).withColumn("at", every(groups))
    pairs = chunks.join(dealt, ["at", "part", "dim"]).select("dim", "n", "width", "least", "ids", "slices", "wide", "query_ids", "queries")
    found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _cells(blocks: int, chunks: int, tasks: int) -> tuple[int, int]:
    """How many groups of blocks and parts of queries: cells of a bounded size, and groups for all tasks if blocks suffice."""
    return max(1, min(blocks, max(-(-blocks // CELL_BLOCKS), tasks))), max(1, -(-chunks // CELL_CHUNKS))


def _parts(vectors: DataFrame) -> int:
    """Partitions for packing: few enough that blocks fill, never more than the input has."""
    return max(1, vectors.sparkSession.sparkContext.defaultParallelism)
