"""The nearest label against all pairs."""

import random

from pyspark.sql import functions as F

from clausework.functions.kernels import label_distance
from clausework.operators import nearest
from clausework.session import ship

LETTERS = "abcdefghijklmnopqrstuvwxyzéß 0123456789"


def labels(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choices(LETTERS[:28], k=r.randint(2, 9))) for _ in range(200)]
    return [r.choice([" ".join(r.choices(words, k=r.randint(1, 4))), "".join(r.choices(LETTERS, k=r.randint(0, 12))), r.choice(words).upper()]) for _ in range(n)]


def test_bounds_never_miss_the_nearest():
    found, wanted = labels(1, 300), labels(2, 80)
    block = nearest.Block(found)
    own, sizes = nearest.counts(wanted)
    for label, c, n in zip(wanted, own, sizes.tolist(), strict=True):
        assert block.nearest(label, c, n) == min((label_distance(label, x), i) for i, x in enumerate(found))


def test_few_of_many_labels_are_compared():
    found = sorted(set(labels(3, 100_000)))
    r = random.Random(4)
    wanted = [x[:i] + r.choice(LETTERS) + x[i + 1 :] for x in r.sample([x for x in found if len(x) > 8], 40) for i in [r.randrange(len(x))]]
    block = nearest.Block(found)
    own, sizes = nearest.counts(wanted)
    for x in zip(wanted, own, sizes.tolist(), strict=True):
        block.nearest(*x)
    assert block.tried < 0.05 * len(found) * len(wanted)


def test_blocks_types_and_ties(spark):
    r = random.Random(5)
    rows = lambda seed, n, at: [(at + i, f"{seed}-{i}", x, r.choice(["A", "B", "C"])) for i, x in enumerate(labels(seed, n))]
    surfaces, canonicals = rows(6, 60, 0) + [(900, "s", None, "A"), (901, "t", "same", "D")], rows(7, 90, 1000) + [(5, "twice", "Same", "B"), (4, "twice", "same", "B"), (3, "n", None, "B")]
    compatible = [("A", "A"), ("B", "B"), ("C", "C"), ("A", "B"), ("D", "B")]
    frame = lambda x: ship(spark).createDataFrame(x, "ord long, id string, label string, type string")
    both = spark.createDataFrame(compatible, "a string, b string")
    want = set()
    for o, i, x, t in surfaces:
        near = [(label_distance(x, c), co, ci, c) for co, ci, c, ct in canonicals if x is not None and c is not None and (t, ct) in compatible]
        if near:
            want.add((i, min(near)[2], min(near)[3], min(near)[0]))
    for block in (7, nearest.BLOCK):
        assert {(r.surface_id, r.canonical_id, r.canonical_label, r.exact) for r in nearest.nearest_labels(frame(surfaces), frame(canonicals), both, block).collect()} == want
    assert nearest.nearest_labels(frame([]), frame(canonicals), both).count() == nearest.nearest_labels(frame(surfaces), frame([]), both).count() == 0


def test_vectors_meet_in_blocks_as_in_all_pairs(spark):
    import numpy as np

    ship(spark)
    r = np.random.default_rng(5)
    base = r.normal(size=(300, 8)).astype(np.float32).astype(float)
    vectors = [*base.tolist(), *base[:60].tolist(), *(2 * base[60:90]).tolist(), [0.0] * 8, None]
    rows = [(i, f"n{i}", f"l{i}", "ab"[i // 2 % 2], v) for i, v in enumerate(vectors)]
    v = spark.createDataFrame(rows, "ord long, id string, label string, type string, vector array<double>")
    same = v.select(F.col("type").alias("a"), F.col("type").alias("b")).distinct()
    found = nearest.nearest_vectors(v.where("ord % 2 = 1"), v.where("ord % 2 = 0"), same, numbers=100)
    got = {x.surface_ord: (x.exact, x.canonical_id) for x in found.collect()}
    assert len(got) == len(rows) // 2
    for i, _, _, kind, x in rows[1::2]:
        if x is None:
            assert got[i] == (None, min((o, c) for o, c, _, k, _ in rows[::2] if k == kind)[1])
            continue
        others = [(o, c, y) for o, c, _, k, y in rows[::2] if k == kind]
        d = nearest.cosine_distances(np.array([x] * len(others)), np.array([y for *_, y in others]))
        wanted = min((e, o, c) for e, (o, c, _) in zip(d.tolist(), others, strict=True))
        assert got[i] == (wanted[0], wanted[2])


def test_vector_blocks_hold_no_group_of_pairs(spark):
    """20,000 surfaces of one type and 20,000 canonicals: pairs of rows, 400 million, would take minutes."""
    import time

    ship(spark)
    v = spark.range(40_000).select(F.col("id").alias("ord"), F.col("id"), F.col("id").alias("label"), F.lit(0).alias("type"), F.array(*(F.rand(i) - 0.5 for i in range(32))).alias("vector"))
    same = spark.createDataFrame([(0, 0)], "a int, b int")
    began = time.time()
    assert nearest.nearest_vectors(v.where("ord % 2 = 1"), v.where("ord % 2 = 0"), same).where("exact < 0.9").count() == 20_000
    assert time.time() - began < 60
