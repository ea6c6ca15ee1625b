"""Trees by pointer doubling against plain walks."""

import random

import pytest
from pyspark.sql import functions as F

from clausework.operators import forest, graphs
from clausework.schema import type_closure


def walk(parents, v):
    out = [v]
    while parents.get(out[-1]) is not None and parents[out[-1]] not in out:
        out.append(parents[out[-1]])
    return out


def links(spark, parents):
    return spark.createDataFrame(list(parents.items()), "node long, parent long")


def some_forest(seed, n=150):
    r = random.Random(seed)
    parents = {0: None, 1: None, 2: 1000}  # 1000 is no node itself
    for v in range(3, n):
        parents[v] = r.choice([v - 1, r.randrange(v), 5, None, v])
    return parents


def test_ancestors_depths_and_spine_against_walks(spark):
    parents = some_forest(1)
    got = {(r.node, r.ancestor, r.depth) for r in graphs.ancestors(links(spark, parents)).collect()}
    assert got == {(v, a, d) for v in parents for d, a in enumerate(walk(parents, v))}
    assert {r.node: r.depth for r in graphs.depths(links(spark, parents)).collect()} == {v: len(walk(parents, v)) - 1 for v in parents}
    start = [7, 90, 149, 12345]
    clauses = links(spark, parents).select(F.col("node").alias("key"), "parent")
    tree = graphs.spine(clauses, spark.createDataFrame([(x,) for x in start], "key long"))
    keys = {a for v in start if v in parents for a in walk(parents, v) if a in parents}
    assert {(r.key, r.parent) for r in tree.collect()} == {(v, parents[v] if parents[v] in keys else None) for v in keys}


def test_cycles_and_several_parents(spark):
    parents = {1: 2, 2: 3, 3: 1, 4: 3, 5: 4, 10: None, 11: 10, 12: 11, 13: 13}
    got = {(r.node, r.ancestor, r.depth) for r in graphs.ancestors(links(spark, parents)).collect()}
    assert got == {(v, a, d) for v in parents for d, a in enumerate(walk(parents, v))}
    assert {r.node: r.depth for r in graphs.depths(links(spark, parents)).collect()} == {v: len(walk(parents, v)) - 1 for v in parents}
    with pytest.raises(ValueError, match="cycle"):
        forest.intervals(links(spark, parents))
    two = spark.createDataFrame([(3, 1), (3, 2), (2, 1), (1, None), (None, 1)], "node long, parent long")
    assert {(r.node, r.ancestor, r.depth) for r in graphs.ancestors(two).collect()} == {(1, 1, 0), (2, 2, 0), (2, 1, 1), (3, 3, 0), (3, 1, 1), (3, 2, 1)}


def test_intervals_tell_ancestors(spark):
    parents = {v: p for v, p in some_forest(2, 90).items() if p != v}
    rows = {r.node: r for r in forest.intervals(links(spark, parents)).collect()}
    nodes = set(parents) | {p for p in parents.values() if p is not None}
    assert set(rows) == nodes and sorted(r.pre for r in rows.values()) == list(range(len(nodes)))
    for u in nodes:
        for v in nodes:
            assert (rows[u].pre <= rows[v].pre <= rows[u].post) == (u in walk(parents, v))
    assert all((rows[v].root, rows[v].depth) == (walk(parents, v)[-1], len(walk(parents, v)) - 1) for v in nodes)


def test_a_chain_of_ten_thousand_takes_few_rounds(spark):
    chain = spark.range(10_000).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    j = forest.jumps(chain)
    assert len(j.levels) <= 14
    rows = graphs.depths(chain)
    assert rows.where("depth <> node").count() == 0 and rows.count() == 10_000


def test_no_links(spark):
    none = spark.createDataFrame([], "node long, parent long")
    assert graphs.ancestors(none).count() == graphs.depths(none).count() == forest.intervals(none).count() == 0


def test_closure_of_a_table_of_types(spark):
    types = spark.createDataFrame([("A", None), ("B", "A"), ("C", "B")], "type string, subtype_of string")
    assert {tuple(r) for r in type_closure(types).collect()} == {("A", "A"), ("B", "B"), ("B", "A"), ("C", "C"), ("C", "B"), ("C", "A")}
