import random
import zlib

import numpy as np

from clausework.llm import nbsvm as N

SCHEMA = "doc_id long, text string, lang string"


def corpus(n=400):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        w = ["".join(rng.choice("abcde") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(10, 60))]
        rows.append((i, " ".join(x.upper() + "!!" if bad else x for x in w), "en"))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_held_out_accuracy_and_labels_of_held_out_rows_have_no_part(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    model = N.train_quality(docs, known.where(~N.held_out()))
    flipped = spark.createDataFrame([(d, 1 - q if zlib.crc32(str(d).encode()) % 3 == 1 else q) for d, q in labels], "doc_id long, quality int")
    assert N.train_quality(docs, flipped.where(~N.held_out())) == model
    truth = dict(labels)
    got = N.score_quality(docs.withColumn("held_out", N.held_out()), model).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d, _ in labels if zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_edges(spark):
    rows, labels = corpus(60)
    docs = spark.createDataFrame([*[(d, t, 0.0) for d, t, _ in rows], (None, None, 1.0), (7, "", 2.0), (7, "x " * 40_000, 2.0)], "doc_id long, text string, score double")
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (4, 1), (4, 1)], "doc_id long, quality int")
    got = N.score_quality(docs, N.train_quality(docs, known)).collect()
    assert len(got) == 63 and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in N.score_quality(docs, N.train_quality(docs, none)).collect()} == {0.5}
    empty = spark.createDataFrame([], SCHEMA)
    assert N.score_quality(empty, N.train_quality(empty, none)).collect() == []


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    vectors = [np.unique(np.concatenate([rng.integers(100, 200, 20), [k % 2]])) for k in range(200)]
    w, b = N.fit(vectors, np.arange(200) % 2)
    margin = np.array([w[v].sum() / np.sqrt(len(v)) + b for v in vectors])
    assert ((margin > 0) == (np.arange(200) % 2 == 1)).all()


def test_words_pairs_and_shapes_are_the_features():
    def of(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return set(N.features(data, np.array([0, len(data)]))[0].tolist())

    assert len(of("ab cd ef")) == 3 + 2 + 3  # words, pairs, and shapes of one to three words
    assert of("ab cd") & of("ef gh") == of("ij") & of("ab cd") | (of("ij kl") & of("ab cd"))
    assert len(of("ab cd") & of("cd ab")) == 2 + 2  # both words and both shape runs, but not the pair


def test_ratios_and_weights_against_brute_force():
    """The fitted model's primal objective against a plain subgradient bound: the gap to the dual is small."""
    rng = np.random.default_rng(4)
    vectors = [np.unique(rng.integers(0, 60, rng.integers(5, 25))) for _ in range(120)]
    labels = np.array([int(30 in v or rng.random() < 0.3) for v in vectors])
    w, b = N.fit(vectors, labels)
    p, q = np.ones(N.BUCKETS), np.ones(N.BUCKETS)
    for v, y in zip(vectors, labels, strict=True):
        for f in v:
            (p if y else q)[f] += 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    x = np.zeros((120, 61))
    for i, v in enumerate(vectors):
        x[i, v] = ratio[v] / np.sqrt(len(v))
        x[i, 60] = 1.0  # the bias is a weight of a constant feature
    y = np.where(labels == 1, 1.0, -1.0)
    alpha = np.zeros(120)
    z = x * y[:, None]
    gram = z @ z.T
    for _ in range(4000):  # projected gradient ascent of the dual, plainly
        alpha = np.clip(alpha + (1 - gram @ alpha) / np.linalg.norm(gram, 2), 0, N.C)
    best = alpha @ z
    primal = lambda u: 0.5 * u @ u + N.C * np.maximum(0, 1 - z @ u).sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        mine = np.append(np.where(ratio[:60] != 0, w[:60] / ratio[:60], 0.0), b)
    assert primal(mine) <= primal(best) * 1.02
    assert np.abs(x @ mine - x @ best).max() < 0.1


def test_many_rows_of_one_labelled_document_are_one_text(spark):
    rows, labels = corpus(80)
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    again = docs.unionByName(docs.where("doc_id < 3").crossJoin(spark.range(500)).drop("id"))
    assert N.train_quality(again, known) == N.train_quality(docs, known)
