"""Secrets in texts: fixed patterns, and a character convolutional network over every candidate with its context.

Patterns find assignments to names such as token or password, access keys, and long runs of hexadecimal digits. Candidates
are the values of these, and every other run of ``LEAST_RUN`` or more letters, digits and ``+/_-`` that has both a letter
and a digit. The network sees a candidate's bytes with ``CONTEXT`` bytes on either side: learned symbols, one layer of
convolutions, largest and mean activations of the candidate and largest ones of its context, and a logistic output. A
candidate of any length is seen whole: long ones are cut to overlapping tiles whose activations are combined.

It is trained on all labelled findings, by default those that the patterns label: by one task while there are at most twice
``TRAIN_FINDINGS``, else dealt by hash to as many tasks as need no more each, whose networks learn from one pass over their
share and are averaged by its size, again and again. Calibration and thresholds then are sums and counts by Spark over all
held-out values. Half of the findings, drawn by hash, lose their context, so that the value
alone must tell. A quarter of the values is held out: on it, without context, outputs are calibrated by a logistic fit, and a
threshold for each shape of values (hexadecimal, capitals, mixed) is the largest that still finds ``RECALL`` of its positives,
and at least one half. The network adds spans; those of the patterns stay.

Defined results: null and empty texts have no spans; positions are code points, ends exclusive; repeated rows, null ids and
ties are scanned like any other; with fewer than ``LEAST_FINDINGS`` positives or negatives no network is trained and nothing is
added; input columns with the names of new ones are replaced, all others but the text are carried.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import stored
from .textops import slices, utf8

KINDS = ("assign", "access", "hex", "network")
CONTEXT, LEAST_RUN, TILE = 24, 12, 256
TRAIN_FINDINGS, LEAST_FINDINGS, RECALL = 3000, 20, 0.95

_ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
_WORDS = (b"passw", b"secret", b"token", b"key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")


def _table(members: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(members)] = True
    return t


_DIGITS, _CAPITALS = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX, _DIGIT, _LETTER = _table(_DIGITS + b"abcdef"), _table(_DIGITS), _table(_CAPITALS + _CAPITALS.lower())
_RUN = _DIGIT | _LETTER | _table(b"+/_-")
_UPPER_OR_DIGIT = _DIGIT | _table(_CAPITALS)


def _long_runs(data: np.ndarray, offsets: np.ndarray, members: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of maximal runs of member bytes of at least ``least``; runs do not cross rows."""
    inside = members[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    at = np.unique(np.concatenate([[0], change, offsets, [len(data)]]))
    lo, hi = at[:-1], at[1:]
    good = (hi - lo >= least) & inside[lo]
    return lo[good], hi[good]


class Found(NamedTuple):
    base: list[tuple[int, int, int]]  # kind, start, end in bytes
    values: list[tuple[int, int, int]]  # start, end, label


def _row(text: bytes, hexes: list[tuple[int, int]], others: list[tuple[int, int]]) -> Found:
    base, values = [], {}
    low = text.lower()
    if any(w in low for w in _WORDS):
        for m in _ASSIGN.finditer(low):
            if m.end(2) - m.start(2) >= 6:
                base.append((0, m.start(), m.end()))
                values[m.span(2)] = 1
    if b"AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                base.append((1, m.start(), m.end()))
                values[m.span()] = 1
    for a, b in hexes:
        base.append((2, a, b))
        values[a, b] = 1
    base.sort(key=lambda x: (x[1], x[0]))
    at, reach = 0, 0  # candidates that touch no span of a pattern
    for a, b in others:
        while at < len(base) and base[at][1] < b:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= a:
            values[a, b] = 0
    return Found(base, sorted((a, b, label) for (a, b), label in values.items()))


_BASE_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
_VALUE_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.int32()), ("before", pa.binary()), ("value", pa.binary()), ("after", pa.binary())]))
_BASE = "array<struct<kind: int, start: long, end: long>>"
_VALUES = "array<struct<start: long, end: long, label: int, before: binary, value: binary, after: binary>>"


def _find(names: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            base, values = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for lo, hi, part, at in slices(data, offsets):
                if not len(part):
                    continue
                characters = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80, dtype=np.int32)])
                digits = np.concatenate([[0], np.cumsum(_DIGIT[part], dtype=np.int32)])
                letters = np.concatenate([[0], np.cumsum(_LETTER[part], dtype=np.int32)])
                hex_a, hex_b = _long_runs(part, at, _HEX, 24)
                run_a, run_b = _long_runs(part, at, _RUN, LEAST_RUN)
                mixed = (digits[run_b] > digits[run_a]) & (letters[run_b] > letters[run_a])
                run_a, run_b = run_a[mixed], run_b[mixed]
                hex_at, run_at = np.searchsorted(hex_a, at), np.searchsorted(run_a, at)
                whole = part.tobytes()
                for r in range(hi - lo):
                    a, b = int(at[r]), int(at[r + 1])
                    row = whole[a:b]
                    of = lambda x, y, w: list(zip((x[w[r] : w[r + 1]] - a).tolist(), (y[w[r] : w[r + 1]] - a).tolist(), strict=True))  # noqa: B023, E731
                    found = _row(row, of(hex_a, hex_b, hex_at), of(run_a, run_b, run_at))
                    point = lambda i: int(characters[a + i] - characters[a])  # noqa: B023, E731
                    base[lo + r] = [{"kind": k, "start": point(x), "end": point(y)} for k, x, y in found.base]
                    values[lo + r] = [
                        {"start": point(x), "end": point(y), "label": label, "before": row[max(0, x - CONTEXT) : x], "value": row[x:y], "after": row[y : y + CONTEXT]} for x, y, label in found.values
                    ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(base, _BASE_TYPE), pa.array(values, _VALUE_TYPE)], [*names, "base", "values"])

    return run


# the network


def shape_of(value: bytes) -> int:
    v = np.frombuffer(value, np.uint8)
    return 0 if _HEX[v].all() else 1 if _UPPER_OR_DIGIT[v].all() else 2


def _tiles(findings: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, whether part of the value, finding): rows of TILE + 4 symbols; 256 fills what is left. Tiles overlap by the
    width of a convolution less one, so that every place is in the middle of just one of them."""
    symbols, inside, owner = [], [], []
    for i, (before, value, after) in enumerate(findings):
        n = len(before) + len(value) + len(after)
        row = np.full(n + 4, 256, np.int16)
        row[2 : n + 2] = np.frombuffer(before + value + after, np.uint8)
        mark = np.zeros(n + 4, bool)
        mark[2 + len(before) : 2 + len(before) + len(value)] = True
        for lo in range(0, max(n, 1), TILE):
            piece = row[lo : lo + TILE + 4]
            symbols.append(np.pad(piece, (0, TILE + 4 - len(piece)), constant_values=256))
            inside.append(np.pad(mark[lo : lo + TILE + 4], (0, TILE + 4 - len(piece))))
            owner.append(i)
    return np.array(symbols), np.array(inside), np.array(owner)


class Network:
    """Symbols of 8 numbers and a mark for the value, 32 convolutions of width 5, pooled; a logistic output."""

    DEPTH, FILTERS, WIDTH = 8, 32, 5

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d, f, w = self.DEPTH, self.FILTERS, self.WIDTH
        self.p = {"e": r.normal(0, 0.3, (257, d)), "c": r.normal(0, (w * (d + 1)) ** -0.5, (w * (d + 1), f)), "b": np.zeros(f), "o": r.normal(0, 0.1, 3 * f), "z": np.zeros(1)}
        self.p["e"][256] = 0

    def _columns(self, symbols: np.ndarray, inside: np.ndarray) -> np.ndarray:
        x = np.concatenate([self.p["e"][symbols], inside[:, :, None]], axis=2)
        n = x.shape[1] - self.WIDTH + 1
        return np.concatenate([x[:, k : k + n] for k in range(self.WIDTH)], axis=2)

    def pooled(self, symbols: np.ndarray, inside: np.ndarray, keep: bool = False):
        """Largest activations in the value, their sum and number, largest ones in the context; with keep also what learning needs."""
        columns = self._columns(symbols, inside)
        act = np.maximum(columns @ self.p["c"] + self.p["b"], 0)
        own = inside[:, 2:-2]
        around = (symbols[:, 2:-2] != 256) & ~own
        a, c = np.where(own[:, :, None], act, 0), np.where(around[:, :, None], act, 0)
        out = a.max(axis=1), a.sum(axis=1), own.sum(axis=1), c.max(axis=1)
        return (*out, columns, act, own, a.argmax(axis=1), c.argmax(axis=1)) if keep else out

    def raw(self, findings: list[tuple[bytes, bytes, bytes]], block: int = 256) -> np.ndarray:
        """The output before calibration for (before, value, after)."""
        out = np.zeros(len(findings))
        for lo in range(0, len(findings), block):
            part = findings[lo : lo + block]
            symbols, inside, owner = _tiles(part)
            pools = [self.pooled(symbols[i : i + block], inside[i : i + block]) for i in range(0, len(symbols), block)]
            most, total, n, around = (np.concatenate(x) for x in zip(*pools, strict=True))
            at = np.searchsorted(owner, np.arange(len(part)))
            most, around = np.maximum.reduceat(most, at), np.maximum.reduceat(around, at)
            mean = np.add.reduceat(total, at) / np.maximum(np.add.reduceat(n, at), 1)[:, None]
            out[lo : lo + len(part)] = np.concatenate([most, mean, around], axis=1) @ self.p["o"] + self.p["z"]
        return out

    def train(self, findings: list[tuple[bytes, bytes, bytes]], labels: np.ndarray, epochs: int = 6, block: int = 64, rate: float = 0.003, share: float | None = None, seed: int = 11) -> None:
        """Adam on the logistic loss; every tile with a part of the value is learned from, and each label weighs the same."""
        m, v, t = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        r, f = np.random.default_rng(seed), self.FILTERS
        symbols, inside, owner = _tiles(findings)
        used = inside[:, 2:-2].any(axis=1)
        used[np.searchsorted(owner, np.arange(len(findings)))] = True
        symbols, inside, labels = symbols[used], inside[used], labels[owner[used]]
        share = labels.mean() if share is None else share
        weight = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
        for _ in range(epochs):
            order = r.permutation(len(labels))
            for lo in range(0, len(order), block):
                i = order[lo : lo + block]
                used = int((symbols[i] != 256).any(axis=0).nonzero()[0].max(initial=2)) + 3
                s, n_in = symbols[i, :used], inside[i, :used]
                most, total, n, around, columns, act, own, top, top_around = self.pooled(s, n_in, keep=True)
                n = np.maximum(n, 1)[:, None]
                x = np.concatenate([most, total / n, around], axis=1)
                p = 1 / (1 + np.exp(-np.clip(x @ self.p["o"] + self.p["z"], -30, 30)))
                err = (p - labels[i]) * weight[i] / len(i)
                grad = {"o": x.T @ err, "z": np.array([err.sum()])}
                back = err[:, None] * self.p["o"][None]
                d_act = np.where(own[:, :, None], (back[:, f : 2 * f] / n)[:, None, :], 0.0)
                rows, filters = np.arange(len(i))[:, None], np.arange(f)[None]
                np.add.at(d_act, (rows, top, filters), back[:, :f] * (most > 0))
                np.add.at(d_act, (rows, top_around, filters), back[:, 2 * f :] * (around > 0))
                d_act *= act > 0
                flat = d_act.reshape(-1, f)
                grad["c"], grad["b"] = columns.reshape(len(flat), -1).T @ flat, flat.sum(axis=0)
                d_columns = (flat @ self.p["c"].T).reshape(len(i), -1, self.WIDTH, self.DEPTH + 1)[..., : self.DEPTH]
                grad["e"] = np.zeros_like(self.p["e"])
                for k in range(self.WIDTH):
                    np.add.at(grad["e"], s[:, k : k + d_columns.shape[1]], d_columns[:, :, k])
                grad["e"][256] = 0
                t += 1
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)


    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def put(self, values: np.ndarray) -> Network:
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = np.array(values[at : at + n], float).reshape(self.p[k].shape)
            at += n
        return self


class Model(NamedTuple):
    """A trained network, its calibration (slope, offset), and a threshold for each shape of values."""

    network: Network
    slope: float
    offset: float
    thresholds: tuple[float, float, float]

    def probability(self, findings: list[tuple[bytes, bytes, bytes]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.network.raw(findings) + self.offset, -30, 30)))


def _logistic(sums: Callable[[float, float, float, float], list[float]], positives: int, negatives: int, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton's method, with targets drawn in a little so that separable values stay finite.

    ``sums`` of slope, offset and the targets of both labels: over all values, of w, w * x, w * x * x, g and g * x."""
    a, b = 0.0, 0.0
    for _ in range(rounds):
        w, wx, wxx, g, gx = sums(a, b, (positives + 1) / (positives + 2), 1 / (negatives + 2))
        step = np.linalg.solve(np.array([[wxx + 1e-6, wx], [wx, w + 1e-6]]), np.array([gx, g]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a, b


def _sums(x: np.ndarray, y: np.ndarray):
    def sums(a: float, b: float, high: float, low: float) -> list[float]:
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w, g = p * (1 - p) + 1e-9, p - np.where(y == 1, high, low)
        return [w.sum(), (w * x).sum(), (w * x * x).sum(), g.sum(), (g * x).sum()]

    return sums


def threshold(probabilities: np.ndarray, recall: float) -> float:
    """The largest threshold at which at least ``recall`` of the positives are found, and at least one half."""
    ordered = np.sort(probabilities)
    return max(0.5, float(ordered[int(np.floor((1 - recall) * len(ordered)))])) if len(ordered) else 0.5


def fit(findings: list[tuple[bytes, bytes, bytes, int]], recall: float = RECALL) -> Model | None:
    """A model of (before, value, after, label); None if either label has fewer than LEAST_FINDINGS in either part."""
    drawn = [hashlib.md5(value).digest() for _, value, _, _ in findings]
    held = np.array([h[0] % 4 == 0 for h in drawn], bool)
    labels = np.array([x[3] for x in findings], float)
    parts = [labels[~held], labels[held]]
    if any((p == y).sum() < LEAST_FINDINGS / (1 if k == 0 else 4) for k, p in enumerate(parts) for y in (0, 1)):
        return None
    seen = [((b"", v, b"") if h[1] % 2 else (b, v, a)) for (b, v, a, _), h in zip(findings, drawn, strict=True)]
    network = Network()
    at = np.flatnonzero(~held)
    network.train([seen[i] for i in at], labels[at])
    at = np.flatnonzero(held)
    alone = [(b"", findings[i][1], b"") for i in at]
    slope, offset = _logistic(_sums(network.raw(alone), labels[at]), int(labels[at].sum()), int((1 - labels[at]).sum()))
    model = Model(network, slope, offset, (0.5, 0.5, 0.5))
    p = model.probability(alone)
    shapes = np.array([shape_of(v) for _, v, _ in alone])
    positive = labels[at] == 1
    every = threshold(p[positive], recall)
    own = [threshold(p[positive & (shapes == s)], recall) if (positive & (shapes == s)).sum() >= LEAST_FINDINGS else every for s in range(3)]
    return model._replace(thresholds=tuple(own))


def labelled(found: DataFrame) -> DataFrame:
    """(before, value, after, label): the distinct values found, each with its first context."""
    rows = found.select(F.explode("values").alias("v")).select("v.*")
    first = F.min(F.struct("before", "after"))
    return rows.groupBy("value", "label").agg(first.alias("c")).select("c.before", "value", "c.after", "label")


def train(findings: DataFrame, size: int = TRAIN_FINDINGS, recall: float = RECALL) -> Model | None:
    """The model of all labelled findings; a task learns from about twice ``size`` of them."""
    drawn = F.md5("value")
    byte = lambda at, n: F.conv(F.substring(drawn, at, n), 16, 10).cast("long")
    rows = stored(findings.select("before", "value", "after", F.col("label").cast("int").alias("label"), (byte(1, 2) % 4 == 0).alias("held"), (byte(3, 2) % 2 == 1).alias("bare"), byte(5, 8).alias("deal")), "labelled")
    counts = {(held, label): n for held, label, n in rows.groupBy("held", "label").count().collect()}
    if any(counts.get((held, y), 0) < LEAST_FINDINGS / (4 if held else 1) for held in (False, True) for y in (0, 1)):
        return None
    if sum(counts.values()) > 2 * size:
        return _dealt(rows, counts, size, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(hashlib.sha256(x["value"]).hexdigest(), x["before"], x["value"], x["after"], x["label"]) for b in batches for x in b.to_pylist()]
        model = fit([x[1:] for x in sorted(found)], recall)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return pickle.loads(rows.select("before", "value", "after", "label").repartition(1).mapInArrow(run, "model binary").collect()[0][0])


#: Digits of what tasks add up: sums of decimals do not depend on their order, so reruns agree.
EXACT, GRID = "decimal(38,15)", 1e9


def _learn(start: np.ndarray, share: float, seed: int):
    def run(table: pa.Table) -> pa.Table:
        own = sorted(((x["value"], x["before"], x["after"], x["label"], x["bare"]) for x in table.to_pylist()), key=lambda x: (hashlib.md5(x[0]).digest(), *x))
        network = Network().put(start)
        network.train([(b"", v, b"") if bare else (b, v, a) for v, b, a, _, bare in own], np.array([x[3] for x in own], float), epochs=1, share=share, seed=seed)
        return pa.table({"n": pa.array([len(own)], pa.int64()), "values": pa.array([network.flat().tolist()], pa.list_(pa.float64()))})

    return run


def _dealt(rows: DataFrame, counts: dict[tuple[bool, int], int], size: int, recall: float, rounds: int = 6) -> Model:
    """The model of more findings than one task learns from."""
    network = Network()
    learned = counts[False, 0] + counts[False, 1]
    share = counts[False, 1] / learned
    parts = -(-learned // (2 * size))
    mine = rows.where("not held").withColumn("part", F.col("deal") % parts)
    for turn in range(rounds):
        made = mine.groupBy("part").applyInArrow(_learn(network.flat(), share, 11 + turn), "n long, values array<double>").select("n", F.posexplode("values").alias("at", "x"))
        mean = made.groupBy("at").agg(F.sum((F.col("x") * F.col("n")).cast(EXACT)).cast("double").alias("x"))
        network.put(np.array([x / learned for _, x in sorted(tuple(r) for r in mean.collect())]))
    trained = network.flat()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network().put(trained)
        for batch in batches:
            values = batch.column("value").to_pylist()
            raw, shape = net.raw([(b"", v, b"") for v in values]), [shape_of(v) for v in values]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(shape, pa.int32()), pa.array(raw, pa.float64())], ["label", "shape", "x"])

    held = stored(rows.where("held").select("label", "value").mapInArrow(score, "label int, shape int, x double"), "outputs")
    x, y = F.col("x"), F.col("label")

    def sums(a: float, b: float, high: float, low: float) -> list[float]:
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x * float(a) + float(b)))))
        w, g = p * (1 - p) + 1e-9, p - F.when(y == 1, high).otherwise(low)
        return [float(v) for v in held.select(*(F.sum(e.cast(EXACT)) for e in (w, w * x, w * x * x, g, g * x))).first()]

    slope, offset = _logistic(sums, counts[True, 1], counts[True, 0])
    # the output that all but a share of the positives reach, for each shape (3: all), by halving on a grid
    sign = -1.0 if slope < 0 else 1.0
    good = held.where("label = 1").select(F.explode(F.array(F.col("shape"), F.lit(3))).alias("shape"), F.floor(x * sign * GRID).alias("x"))
    spans = {k: [lo, hi, n, int(np.floor((1 - recall) * n))] for k, lo, hi, n in good.groupBy("shape").agg(F.min("x"), F.max("x"), F.count(F.lit(1))).collect()}
    while any(lo < hi for lo, hi, *_ in spans.values()):
        middle = {k: (lo + hi) // 2 for k, (lo, hi, *_) in spans.items()}
        below = dict(good.groupBy("shape").agg(F.count_if(F.col("x") <= F.coalesce(*(F.when(F.col("shape") == k, F.lit(m)) for k, m in middle.items())))).collect())
        for k, span in spans.items():
            if below[k] > span[3]:
                span[1] = middle[k]
            else:
                span[0] = min(middle[k] + 1, span[1])
    at = {k: max(0.5, 1 / (1 + float(np.exp(-np.clip(abs(slope) * lo / GRID + offset, -30, 30))))) for k, (lo, *_) in spans.items()}
    own = [at[k] if k in spans and spans[k][2] >= LEAST_FINDINGS else at[3] for k in range(3)]
    return Model(network, slope, offset, tuple(own))


def _scored(names: list[str], model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(x["start"], x["kind"], x["end"], None) for x in row] for row in batch.column("base").to_pylist()]
            if model:
                found = [(i, x) for i, row in enumerate(batch.column("values").to_pylist()) for x in row]
                p = model.probability([(x["before"], x["value"], x["after"]) for _, x in found])
                for (i, x), score in zip(found, p.tolist(), strict=True):
                    if x["label"] == 0 and score >= model.thresholds[shape_of(x["value"])]:
                        spans[i].append((x["start"], 3, x["end"], score))
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "score": score} for a, k, b, score in sorted(row, key=lambda s: s[:3])] for row in spans]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(rows, _SPAN_TYPE)], [*names, "spans"])

    return run


_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
_SPANS = "array<struct<kind: string, start: long, end: long, score: double>>"


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, text: str = "text", size: int = TRAIN_FINDINGS, recall: float = RECALL) -> DataFrame:
    """docs without their text, with ``spans``: array of (kind, start, end, score), by start, then kind as in KINDS.

    ``findings`` (before, value, after, label: 0 or 1) are what the network learns from; without them, what the patterns label.
    """
    docs = docs.drop(*(c for c in ("base", "values", "spans") if c != text))
    names = [c for c in docs.columns if c != text]
    carried = T.StructType([docs.schema[c] for c in names])
    shape = lambda **more: T.StructType([*carried.fields, *(T.StructField(k, T._parse_datatype_string(v)) for k, v in more.items())])
    found = stored(docs.mapInArrow(_find(names, text), shape(base=_BASE, values=_VALUES)), "findings")
    model = train(labelled(found) if findings is None else findings, size, recall)
    return found.mapInArrow(_scored(names, model), shape(spans=_SPANS))


def spans_digest(found: DataFrame) -> DataFrame:
    """found with n_assign, n_access, n_hex, base_sha256, and spans as kind:start:end joined by commas."""
    line = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "network")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(line(base), 256).alias("base_sha256"), count("network"), line("spans").alias("spans"))
