import random
import re
import time

import numpy as np

from clausework.llm import ngram_jaccard as J
from clausework.llm import textops as X
from clausework.llm.cluster import connected_components

SCHEMA = "doc_id long, text string"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def brute(rows):
    sets = {}
    for d, t in rows:
        w = words(t)
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = [d for d in sets if sets[d]]
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def corpus(seed, n=45):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ß-x", "W1"]
    texts = []
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 6, 9, 40, 150]))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            c = list(base)
            for _ in range(rng.randint(0, max(1, len(c) // 25))):
                c[rng.randrange(len(c))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(c))
    rng.shuffle(texts)
    return list(enumerate([*texts, None, "", " \n", "x", "X", "long " * 30_000, "long " * 30_001]))


def result(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.ngram_jaccard(df, **options).collect()}


def test_equals_brute_force_in_one_tile_and_in_many(spark):
    rows = corpus(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = brute(rows)
    assert result(df) == expected
    assert result(df, tile_shingles=500) == expected


def test_sizes_of_templates_and_bands_against_brute_force(spark):
    """Templates whose slots leave pairs on both sides of the threshold, in tiles so small that all stages are used."""
    rng = random.Random(11)
    base = [f"t{i}" for i in range(40)]
    rows = []
    for i in range(160):
        w = list(base)
        for slot in rng.sample(range(0, 40, 9), rng.randint(0, 3)):
            w[slot] = f"v{rng.randint(0, 6)}"
        rows.append((i, " ".join(w[: rng.choice([36, 38, 40])] + [f"tail{i % 23}"] * rng.randint(0, 3))))
    rows += [(200 + i, f"thank you for your order number {i}") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute(rows)
    assert len({c for _, c in expected.values()}) > 70
    for tile in (150, 900, J.TILE_SHINGLES):
        assert result(df, tile_shingles=tile) == expected


def sets_of(sets):
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def test_short_texts_of_one_template_do_not_meet():
    """40,000 sets of two common shingles and one of their own: no pair is compared."""
    own = X.mix(np.arange(40_000, dtype=np.uint64))
    sets = [np.sort(np.array([11, 22, v], np.uint64)) for v in own]
    start = time.time()
    assert J.linked_pairs(*sets_of(sets), np.arange(len(sets))) == []
    assert time.time() - start < 5


def order_mails(n, extra=0):
    base = "dear customer we are glad to tell you that the parcel of order number {} has left our store and will reach you soon thanks"
    return [base.format(i) + " friend" * (i % 3 if extra else 0) for i in range(n)]


def test_order_mails_of_similarity_below_the_threshold_do_not_meet():
    """50,000 texts of 21 shingles, 16 of them common to all (similarity 0.62), in one task; of several lengths too."""
    for texts in (order_mails(50_000), order_mails(20_000, 1)):
        data = "".join(texts).encode()
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        h, bounds = X.shingle_sets(np.frombuffer(data, np.uint8), offsets)
        start = time.time()
        assert J.linked_pairs(h, bounds, np.arange(len(texts))) == []
        assert time.time() - start < 10


def test_order_mails_of_many_tiles_end_to_end(spark):
    rows = list(enumerate(order_mails(3000)))
    near = [(5000 + i, rows[i][1] + " bye") for i in range(0, 3000, 100)]  # 21 of 22 shingles common
    got = result(spark.createDataFrame(rows + near, SCHEMA).repartition(4), tile_shingles=5000)
    assert all(got[i] == (21, i) for i, _ in rows) and all(got[i] == (22, i - 5000) for i, _ in near)


def test_template_texts_end_to_end_without_links(spark):
    n = 40_000
    df = spark.range(n).selectExpr("id as doc_id", "concat('thank you for your order number ', id) as text")
    got = J.ngram_jaccard(df)
    assert got.where("component_id <> doc_id or n_shingles <> 3").count() == 0 and got.count() == n


def test_random_sets_of_a_tile_against_all_pairs():
    rng = np.random.default_rng(12)
    for seed in range(25):
        pool = X.mix(np.arange(60, dtype=np.uint64) + np.uint64(1000 * seed))
        base = [rng.choice(pool, rng.integers(2, 30), replace=False) for _ in range(4)]
        sets = []
        for _ in range(60):
            b = base[rng.integers(4)]
            keep = b[rng.random(len(b)) > 0.12]
            sets.append(np.unique(np.concatenate([keep, rng.choice(pool, rng.integers(0, 4))])))
        pairs = J.linked_pairs(*sets_of(sets), np.arange(60))
        parent = list(range(60))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for i in range(60):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
        mine = list(range(60))
        for a, b in pairs:
            mine[root(a, mine)] = root(b, mine)
        same = lambda p: [[root(i, p) == root(j, p) for i in range(60)] for j in range(60)]
        assert same(mine) == same(parent)


def test_a_document_of_many_rows_is_one_set(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (1, "q r s t u v w")]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.unionByName(df.where("doc_id = 1").crossJoin(spark.range(2000)).drop("id"))
    assert {tuple(r) for r in J.ngram_jaccard(df).collect()} == {(1, 4, 1), (2, 5, 1), (1, 3, 1)}


def test_nulls_repeats_extra_columns_and_empty_tables(spark):
    rows = [(None, "a b c d e f", 1), (3, "a b c d e f", 2), (3, "a b c d e f", 2), (4, "A b c d e f", 3), (5, None, None), (5, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.ngram_jaccard(df).collect()), key=str)
    assert got == sorted([(None, 2, None), (3, 2, 3), (3, 2, 3), (4, 2, 3), (5, 0, 5), (5, 0, 5)], key=str)
    assert J.ngram_jaccard(spark.createDataFrame([], SCHEMA)).collect() == []


def test_spanning_pairs_skip_nothing_between_components():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[: 200 - k], rng.integers(0, 1 << 60, k).astype(np.uint64)])) for k in (0, 10, 20, 30, 60, 100)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    pairs = J.linked_pairs(np.concatenate(sets), bounds, np.arange(6))
    joined = {frozenset(p) for p in pairs}
    links = set()
    for i in range(6):
        for j in range(i + 1, 6):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                links.add(frozenset((i, j)))
    assert joined <= links
    assert {x for p in joined for x in p} == {x for p in links for x in p}


def test_components_of_paths_stars_and_random_edges(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 350)] + [(500, 500 + i) for i in range(30)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}


def test_hashes_do_not_depend_on_place_or_slice():
    data = np.frombuffer(b"abc abd abc", np.uint8)
    h = X.Hashes(data).of(np.array([0, 4, 8]), np.array([3, 7, 11]))
    assert h[0] == h[2] != h[1]
