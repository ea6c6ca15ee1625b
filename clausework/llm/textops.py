"""Vectorised text kernels shared by the operators of this subpackage.

Everything here runs inside Spark tasks on Arrow batches: a batch's texts are taken as one UTF-8 buffer with offsets and
processed in slices of a bounded number of bytes, so that memory follows the slice and the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 512 << 10
#: Word separators: space and the control characters 0x09-0x0D; a word is any other run of bytes.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_RNG = np.random.default_rng(0x5EED)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)
_POSITION = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        n = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        for base, name in ((_BASE, "_POWERS"), (_BASE_INVERSE, "_INVERSES")):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS, _INVERSES


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, nulls as empty, and the n+1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string_view(column.type) or pa.types.is_binary_view(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(data: np.ndarray, offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of runs of whole rows of about ``size`` bytes; a longer row has its own run."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Hashes:
    """64-bit hashes of any byte ranges of a buffer, from prefix sums: equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        powers, self.inverses = _powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers[: self.n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of every word; words do not cross rows."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e
    inside = ~_IS_SEPARATOR[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = offsets[:-1][np.diff(offsets) > 0]
    first[at] = inside[at]
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; all other bytes stay."""
    return _LOWER[data]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of lower-cased texts, in order."""
    starts, ends, row = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), row
    return Hashes(lower_ascii(data)).of(starts, ends), row


def ngram_hashes(words: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of n words inside a row; rows with fewer words give none."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(words) - n + 1
    total = words[:m] * _POSITION[0]
    for k in range(1, n):
        total = total + words[k : k + m] * _POSITION[k]
    whole = row[:m] == row[n - 1 :]
    return mix(total[whole] + np.uint64(n)), row[:m][whole]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, n_rows+1 bounds): the set of row i is ``hashes[bounds[i]:bounds[i+1]]``.

    A row of fewer than n words has its whole sequence as one shingle; a row without words has the empty set.
    """
    rows = len(offsets) - 1
    words, row = word_hashes(data, offsets)
    h, r = ngram_hashes(words, row, n)
    count = np.bincount(row, minlength=rows)
    for k in range(1, n):  # the few rows with just k words
        few = count[row] == k
        if few.any():
            a, b = ngram_hashes(words[few], row[few], k)
            h, r = np.concatenate([h, a]), np.concatenate([r, b])
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    if len(h):
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        h, r = h[keep], r[keep]
    return h, np.searchsorted(r, np.arange(rows + 1))


def by_row(values: np.ndarray, bounds: np.ndarray, reduce: np.ufunc, empty) -> np.ndarray:
    """reduce over each row's run of values; rows without values get ``empty``."""
    out = np.full(len(bounds) - 1, empty, values.dtype)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        out[full] = reduce.reduceat(values, bounds[full])
    return out


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with equal ``key``, from batches sorted by it; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if held and keys[lo] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)
