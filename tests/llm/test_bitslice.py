import random

import numpy as np
from pyspark.sql import functions as F

from clausework.llm import bitslice as B

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    v = {}
    for i, e in rows:
        if i is None or e is None or not len(e) or any(x is None or not np.isfinite(x) for x in e):
            continue
        v.setdefault(i, set()).add(tuple(int(np.floor(256 * float(np.float32(x)))) for x in e))
    flat = [(i, e) for i, es in v.items() for e in es]
    out = []
    for q, qe in flat:
        if q % every == 0:
            scored = {(-sum(a * b for a, b in zip(qe, e, strict=True)), i) for i, e in flat if i != q and len(e) == len(qe)}
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_equals_brute_force_with_ties_and_unsound_rows(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * rng.choice([1, 1, 40]) for _ in range(9)]) for i in range(180)]
    rows += [(200 + i, rows[3][1]) for i in range(12)] + [(300, None), (301, [1.0, None]), (302, [float("nan")] * 9), (None, rows[0][1]), (310, [0.5, -0.5]), (320, [0.25, 1.0]), (330, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", rank int").repartition(3)
    for block in (8192, 64, 7):
        got = B.top_k(df, F.col("vec_id") % 10 == 0, k=5, block_rows=block).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, 10, 5)


def test_repeated_rows_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [0.0, 0.0])]
    got = B.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, k=5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, 5, 5)
    assert B.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0).collect() == []


def test_adders_give_exact_scores():
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, (130, 11))
    slices, least = B.slices_of(x)
    for q in (rng.integers(-90, 90, 11), np.zeros(11, np.int64), np.full(11, -1)):
        digits = B.added(slices, q)
        bits = np.stack([np.unpackbits(d.view(np.uint8), bitorder="little")[:130] for d in digits]).astype(np.int64)
        score = (bits << np.arange(len(digits))[:, None]).sum(axis=0) - int(-q[q < 0].sum()) * ((1 << slices.shape[1]) - 1) + least * int(q.sum())
        assert (score == x @ q).all()


def test_more_copies_than_k_in_one_block(spark):
    rows = [(0, [1.0, 1.0])] * 3 + [(1, [9.0, 9.0])] * 12 + [(2, [8.0, 8.0])] * 7 + [(2, [8.001, 8.0])] + [(i, [7.0, float(-i)]) for i in range(3, 20)]
    got = B.top_k(spark.createDataFrame(rows, SCHEMA).coalesce(1), F.col("vec_id") == 0, k=5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, 100, 5)


def test_components_beyond_the_slices_score_exactly(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(40)]
    rows += [(40 + i, [rng.uniform(-1, 1) * 10 ** rng.choice([4, 5, 6]) for _ in range(3)]) for i in range(20)]
    rows += [(100, [7e4, 1.0, 0.0]), (101, [8e4, 1.0, 0.0]), (102, [0.0, 1e8, 0.0])]
    got = B.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, k=5, block_rows=16).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, 10, 5)


def test_cells_grow_with_blocks_and_queries_and_change_nothing(spark, monkeypatch):
    assert B._cells(0, 0, 8) == (1, 1) and B._cells(3, 1, 8) == (3, 1) and B._cells(100, 65, 8) == (25, 2) and B._cells(10, 1, 8) == (8, 1)
    monkeypatch.setattr(B, "CHUNK_QUERIES", 3)
    monkeypatch.setattr(B, "CELL_CHUNKS", 2)
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(120)]
    clashing = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA + ", at int, part int, score string")
    got = B.top_k(clashing, F.col("vec_id") % 4 == 0, k=3, block_rows=16).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, 4, 3)
