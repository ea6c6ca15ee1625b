import random
import re
from collections import defaultdict

from clausework.llm import mixing as M

SCHEMA = "doc_id long, source string, text string"


def targets(sizes, budget=1.5, cap=2.0):
    """Water-filling by clamping again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    left, open_, out = budget * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s] + 1e-9}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def corpus(seed):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", "a", "a", "b", "c", "d", "Z", "é", None]), rng.choice([None, "", "x " * rng.randint(1, 30), "word\x0bword\tword " * rng.randint(1, 300)])) for i in range(600)]


def test_targets_and_taken(spark):
    rows = corpus(3)
    got = M.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    count = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, _, t in rows}
    sizes = defaultdict(int)
    for d, s, _ in rows:
        sizes[s] += count[d]
    expected = targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.size == count[r.doc_id] and r.source_size == sizes[r.source]
        assert abs(r.target - expected[r.source]) < 1e-6 * max(1, expected[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    for s, t in expected.items():
        assert abs(taken[s] - t) <= 0.01 * t + 300
    again = M.mix_sources(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in got}


def test_one_large_group_of_equal_documents_stays_near_its_target(spark):
    rows = [(i, "hot", "same five words are here") for i in range(500)] + [(1000 + i, "cold", "w " * (i + 1)) for i in range(60)]
    got = M.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    for s in ("hot", "cold"):
        part = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in part) - part[0].target) <= 0.02 * part[0].target


def test_clashing_names_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, None, "a b", 5, "k"), (1, "s", None, 6, "l"), (1, "s", None, 6, "l")], "doc_id long, source string, text string, size int, key string")
    got = M.mix_sources(df).collect()
    assert sorted((r.size, r.key) for r in got) == [(0, "l"), (0, "l"), (2, "k")]
    assert M.mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []


def test_another_seed_takes_other_documents_and_keeps_targets(spark):
    rng = random.Random(8)
    rows = [(i, "ab"[i % 2], "w " * size) for i, size in enumerate(rng.sample(range(20, 2000), 600))]
    df = spark.createDataFrame(rows, SCHEMA)
    first, second = ({r.doc_id: r for r in M.mix_sources(df, weights=(1, 1), seed=s).collect()} for s in ("one", "two"))
    open_ = [d for d, r in first.items() if r.target < 2 * r.source_size]
    assert sum(first[d].copies != second[d].copies for d in open_) > 0.3 * len(open_)
    for got in (first, second):
        for s in "ab":
            part = [r for r in got.values() if r.source == s]
            assert abs(sum(r.taken for r in part) - part[0].target) <= 0.01 * part[0].target


def test_many_sources_are_placed_in_code_point_order(spark):
    sizes = {f"s{i:04}": 10 + i * 7 % 50 for i in range(1500)} | {"É": 11, "Z": 12, None: 13}
    got = {r.source: r for r in M.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    expected = targets(sizes)
    assert all(abs(got[s].target - t) < 1e-6 * t for s, t in expected.items()) and len(got) == len(expected)


def test_null_ids_and_a_very_long_text(spark):
    rows = [(None, "a", "x " * n) for n in range(1, 80)] + [(None, "a", "y " * n) for n in range(1, 80)] + [(1, "b", "long " * 200_000)]
    runs = [sorted((r.source, r.size, r.copies) for r in M.mix_sources(spark.createDataFrame(rows, SCHEMA).repartition(p)).collect()) for p in (2, 5)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows) and runs[0][-1][1] == 200_000


def test_no_python_in_the_plan(spark):
    plan = M.mix_sources(spark.createDataFrame(corpus(1)[:20], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
