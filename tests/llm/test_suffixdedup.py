import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from clausework.llm import suffixdedup as S

SCHEMA = "doc_id long, text string"


def brute(rows, n, keep_first):
    where = defaultdict(list)
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        for s in range(len(b) - n + 1):
            where[b[s : s + n]].append((d, s))
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - n + 1):
            w = where[b[s : s + n]]
            if len(w) > 1 and not (keep_first and w[0] == (d, s)):
                gone[s : s + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d] = (len(b), sum(gone), sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1])), hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 40))) for _ in range(6)]
    rows = []
    for i in range(100):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(0, 6))]
        rows.append((i, " ".join(parts)))
    return [*rows, (100, None), (101, ""), (102, "a" * 300), (103, "ab" * 120), (104, rows[3][1]), (105, rows[3][1] + "x"), (106, "a" * 90)]


@pytest.mark.parametrize(("n", "k"), [(40, 16), (24, 10), (90, 40)])
@pytest.mark.parametrize("keep_first", [False, True])
def test_equals_brute_force(spark, n, k, keep_first):
    rows = corpus(n)
    got = S.substring_dedup(spark.createDataFrame(rows, SCHEMA).repartition(4), n, keep_first, digest=True, k=k).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute(rows, n, keep_first)


def test_large_groups_are_sorted_in_parts(spark, monkeypatch):
    rows = corpus(9)
    monkeypatch.setattr(S, "SORT_ROWS", 50)
    got = S.substring_dedup(spark.createDataFrame(rows, SCHEMA), 40, False, digest=True, k=16).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute(rows, 40, False)


@pytest.mark.parametrize("keep_first", [False, True])
def test_crowded_anchors_are_looked_up(spark, keep_first):
    rows = corpus(11)
    got = S.substring_dedup(spark.createDataFrame(rows, SCHEMA), 40, keep_first, digest=True, k=16, crowd=1).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute(rows, 40, keep_first)


def test_spans_kept_bytes_repeats_and_empty(spark):
    p = "this passage is long enough to be found again by its bytes"
    rows = [(1, "x" + p + "y"), (2, "z" + p), (2, "z" + p), (None, p), (3, "short")]
    got = S.substring_dedup(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", kept int"), 40, True, k=16).collect()
    by = sorted((str(r.doc_id), bytes(r.kept), [(s.start, s.end) for s in r.spans]) for r in got)
    assert by[0] == ("1", b"xy", [(1, 1 + len(p))]) and by[3] == ("3", b"short", []) and by[4][1] == p.encode()
    assert S.substring_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_previous_and_next_positions():
    text = np.frombuffer(b"abcabcab", np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(text, 3)
    back, ahead = S.suffix_matches(windows, np.arange(6))
    assert back.tolist() == [0, 0, 0, 3, 3, 3] and ahead.tolist() == [3, 3, 3, 0, 0, 0]


def test_previous_and_next_factors_against_brute_force():
    rng = np.random.default_rng(5)
    for letters, length in ((2, 12), (4, 6), (1, 9)):
        windows = rng.integers(97, 97 + letters, (150, length)).astype(np.uint8)
        order = rng.permutation(150)
        back, ahead = S.suffix_matches(windows, order)
        shared = lambda a, b: int(np.argmin(np.append(windows[a] == windows[b], False)))  # noqa: B023, E731
        for i in range(150):
            assert back[i] == max((shared(i, j) for j in range(150) if order[j] < order[i]), default=0)
            assert ahead[i] == max((shared(i, j) for j in range(150) if order[j] > order[i]), default=0)


@pytest.mark.parametrize("keep_first", [False, True])
def test_long_passages_and_a_very_long_text(spark, keep_first):
    rng = random.Random(21)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = letters(700)
    rows = [(i, letters(300) + passage[i * 20 :] + letters(200)) for i in range(8)] + [(8, letters(150_000) + passage + letters(150_000)), (9, letters(390))]
    got = S.substring_dedup(spark.createDataFrame(rows, SCHEMA), 400, keep_first, digest=True).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute(rows, 400, keep_first)


def test_hashes_alone_remove_nothing(spark, monkeypatch):
    """Whole copies and equal runs stay where the factors of the sorted suffixes are not asked."""

    def unsorted(min_bytes):
        def run(batches):
            for batch in batches:
                yield from ()

        return run

    rows = corpus(40)
    monkeypatch.setattr(S, "_sorted_runs", unsorted)
    got = S.substring_dedup(spark.createDataFrame(rows, SCHEMA), 40, False, digest=True, k=16).collect()
    assert sum(r.n_removed for r in got) == 0


@pytest.mark.parametrize("crowd", [1, 5_000])
def test_rows_that_repeat_a_document_are_no_earlier_copies_of_it(spark, crowd):
    p = "a passage that stands in several documents, long enough for it to be found"
    rows = [(1, "first " + p + " one"), (1, "first " + p + " one"), (2, "then " + p + " two"), (2, "then " + p + " two"), (3, p)]
    got = S.substring_dedup(spark.createDataFrame(rows, SCHEMA), 40, True, k=16, crowd=crowd).collect()
    kept = sorted((r.doc_id, bytes(r.kept)) for r in got)
    assert [d for d, k in kept if len(k) > 40] == [1, 1] and kept[4] == (3, b"")
