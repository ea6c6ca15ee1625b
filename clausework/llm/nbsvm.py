"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by class log-count ratios.

Terms are hashed into ``BUCKETS`` features: words as written and pairs of words, and runs of one to three word shapes
(letters, capitals and digits each collapsed to one sign, other characters kept). A text's vector has, for each of its k
features, the feature's log-count ratio r = log((p/|p|) / (q/|q|)) over smoothed document counts p, q of the two classes,
divided by sqrt(k). Dual coordinate descent fits weights and a bias for the hinge loss, until no coordinate's projected
gradient exceeds ``TOLERANCE`` in a pass, ``EPOCHS`` passes at most; the score is the logistic of the scaled margin.

The fit reads labelled documents only, at most about ``TRAIN_ROWS`` of them (those with the smallest seeded hashes of doc_id,
so every labelled one is as likely to be taken), one text of each; it runs in one task whose input that bound limits. Scoring is one narrow pass
over all documents.

Defined results: null or empty text scores by the bias alone; a doc_id with several labels takes their majority, ties
counting as 1; null labels are ignored; without labelled rows of both classes every score is the share of label 1 (0.5
without any); repeated rows score alike, and of a doc_id's texts the least is learnt from; an empty table gives an empty result; input columns named score or predicted are
replaced, others are carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops as X

BUCKETS = 1 << 20
TRAIN_ROWS = 12_000
C = 1.0
EPOCHS = 40
TOLERANCE = 0.02
MARGIN_SCALE = 3.0

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_SHAPE[128:] = ord("a")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets, n_rows+1 bounds) of each row's text."""
    rows = len(offsets) - 1
    starts, ends, row = X.word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
    words = X.Hashes(data).of(starts, ends)
    shape = _SHAPE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    shapes = X.Hashes(shape[keep]).of(place[starts], place[ends])
    parts = [(words, row), X.ngram_hashes(words, row, 2)] + [X.ngram_hashes(shapes, row, n) for n in (1, 2, 3)]
    salt = np.arange(1, len(parts) + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
    bucket = np.concatenate([(X.mix(h ^ s) % np.uint64(BUCKETS)).astype(np.int64) for (h, _), s in zip(parts, salt, strict=True)])
    key = np.unique(np.concatenate([r for _, r in parts]) * BUCKETS + bucket)
    return key % BUCKETS, np.searchsorted(key // BUCKETS, np.arange(rows + 1))


def fit(vectors: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """(weight of each bucket's indicator, bias) from distinct buckets of each text and its 0/1 label."""
    positive = labels > 0
    if not len(labels) or positive.all() or not positive.any():
        share = float(positive.mean()) if len(labels) else 0.5
        return np.zeros(BUCKETS, np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)) / MARGIN_SCALE)
    counts = np.ones((2, BUCKETS))
    for v, y in zip(vectors, positive, strict=True):
        counts[int(y), v] += 1
    ratio = np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))
    y = np.where(positive, 1.0, -1.0)
    scale = [1 / np.sqrt(max(1, len(v))) for v in vectors]
    squares = np.array([(ratio[v] ** 2).sum() * s * s + 1.0 for v, s in zip(vectors, scale, strict=True)])
    w, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in rng.permutation(len(y)):
            v = vectors[i]
            x = ratio[v] * scale[i]
            gradient = y[i] * (w[v] @ x + bias) - 1
            worst = max(worst, abs(min(gradient, 0.0) if alpha[i] <= 0 else max(gradient, 0.0) if alpha[i] >= C else gradient))
            new = min(max(alpha[i] - gradient / squares[i], 0.0), C)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[v] += step * x
                bias += step
                alpha[i] = new
        if worst <= TOLERANCE:
            break
    return (w * ratio).astype(np.float32), float(bias)


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vectors, labels, ids = [], [], []
    for batch in batches:
        data, offsets = X.utf8(batch.column("text"))
        for _, _, part, at in X.slices(data, offsets):
            f, bounds = features(part, at)
            vectors += [f[a:b].astype(np.int32) for a, b in zip(bounds, bounds[1:], strict=False)]
        labels += batch.column("label").to_pylist()
        ids += batch.column("at").to_pylist()
    order = sorted(range(len(ids)), key=ids.__getitem__)  # rows arrive in any order; the fit must not depend on it
    w, bias = fit([vectors[i] for i in order], np.array([labels[i] for i in order], np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([bias], pa.float64())], ["weights", "bias"])


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS) -> tuple[bytes, float]:
    """(float32 weights as bytes, bias) fitted on about ``train_rows`` labelled documents at most."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
    known = known.withColumn("at", F.xxhash64(F.col("doc_id"), F.lit(11)))
    n = known.count()
    if n > train_rows:
        share = train_rows / n
        known = known.where(F.col("at") < int(share * 2**64) - 2**63)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    sample = texts.join(F.broadcast(known), "doc_id")  # the sample's bound keeps it small
    sample = sample.groupBy("doc_id", "label", "at").agg(F.min("text").alias("text"))
    rows = sample.repartition(1).mapInArrow(_fit_task, "weights binary, bias double").collect()
    return (bytes(rows[0].weights), rows[0].bias) if rows else (np.zeros(BUCKETS, np.float32).tobytes(), 0.0)


def score_quality(docs: DataFrame, model: tuple[bytes, float], text: str = "text") -> DataFrame:
    """docs with score double and predicted int; text is the only column that a score depends on."""
    docs = docs.drop("score", "predicted")
    weights = docs.sparkSession.sparkContext.broadcast(model[0])
    bias, names = model[1], docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(weights.value, np.float32).astype(np.float64)
        for batch in batches:
            data, offsets = X.utf8(batch.column(text))
            margin = np.full(batch.num_rows, bias)
            for lo, hi, part, at in X.slices(data, offsets):
                f, bounds = features(part, at)
                margin[lo:hi] += X.by_row(w[f], bounds, np.add, 0.0) / np.sqrt(np.maximum(1, np.diff(bounds)))
            score = 1 / (1 + np.exp(-np.clip(MARGIN_SCALE * margin, -60, 60)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def held_out():
    """Whether a document's label is kept from training: crc32 of doc_id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
