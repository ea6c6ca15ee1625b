"""Words grouped with their spelling variants: all near words, without a pair ever being made.

Two words are near if one code point that is replaced, inserted or deleted turns one into the other. Replacements meet in
wildcard groups: a word belongs to one group for each of its places, named by place, prefix and suffix; two words share a
group exactly if they differ at that place alone. A group keeps its size and its two first words by count, so each member
knows how many others there are and the best of them. A word's deletions join the vocabulary: the word that a deletion names
learns how many longer words lead to it and which is best, and the longer word learns of the shorter one. Sums and best
words over both kinds are aggregations by word. Rows are linear in the letters of the vocabulary; a group has at most as many
members as the alphabet has letters, a deletion as many as there are letters times places.

Strings are left behind at once: a word is its rank in code-point order, groups and deletions are 128-bit hashes made from
prefix and suffix hashes, so that a word of any length takes rows of fixed size.

Every word follows its forms, each with at least ``RATIO`` times the occurrences of the one before, to the last, by pointer
doubling.

Defined results: null text has no words; a null doc_id counts as empty text before the colon; repeated rows count again; an
empty table has no words; other columns are left aside, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cluster import stored
from .scan import ranges, scanned
from .textops import mix

#: A word's least length in code points and least number of occurrences; a form has at least RATIO times the word's.
MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
#: One in so many (document, run) loses a code point.
NOISE = 199
#: Texts are searched in pieces of about so many characters, cut between runs.
PIECE_CHARS = 1 << 20
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
#: Rows of wildcards or deletions made at a time.
HELD_ROWS = 1 << 16

_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_BETWEEN = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = {c: c + 32 for c in range(65, 91)}


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE_CHARS:
        cut = _BETWEEN.search(text, at + PIECE_CHARS)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def runs(text: str | None) -> Counter:
    """Lower-cased runs of a whole text and how often each stands there."""
    found: Counter = Counter()
    for piece in _pieces(text or ""):
        found.update(_RUNS.findall(piece.translate(_LOWER) if len(piece) < 64 else _lowered(piece)))
    return found


def _lowered(text: str) -> str:
    """A-Z to a-z, nothing else: bytes.lower knows ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def noisy(doc_id: int | None, run: str) -> str:
    """The run, or, for one (document, run) in ``NOISE``, the run without one of its code points."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return made

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for run, n in runs(text).items():
                if len(run) >= MIN_CHARS:
                    word = noisy(doc, run)
                    if len(word) >= MIN_CHARS:
                        held[word] += n
            if len(held) >= HELD_WORDS:
                yield rows()
    yield rows()


def vocabulary(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(id, word, n): the words of all documents with at least ``min_count`` occurrences; id is the rank in code-point order."""
    counted = docs.select("doc_id", "text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    counted = stored(counted.select("word", "n", F.lit(1).cast("long").alias("id")), "words")
    return scanned(counted, [], [F.col("word").asc()], sums=["id"], keep=["word", "n"])


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(wildcards, deletions) of words of one length, a row of code points each: two 64-bit hashes for each place, and behind
    the deletions for the word itself."""
    rows, n = points.shape
    made = [], []
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    for salt in (np.uint64(0x51ED270B7A2F3C1D), np.uint64(0xA0761D6478BD642F)):
        letters = mix(points + salt)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))[:n]
        sums = np.zeros((rows, n + 1), np.uint64)  # of the letters before each place
        np.cumsum(letters * powers, axis=1, out=sums[:, 1:])
        after = sums[:, -1:] - sums[:, 1:]
        made[0].append(mix(sums[:, :-1] + after + mix(np.arange(n, dtype=np.uint64) + np.uint64(1)) + mix(np.uint64([n]) + salt)))
        gone = mix(sums[:, :-1] + after * inverse + mix(np.uint64([n - 1]) ^ salt))  # what follows moves one place to the left
        made[1].append(np.concatenate([gone, mix(sums[:, -1:] + mix(np.uint64([n]) ^ salt))], axis=1))
    return np.stack(made[0]), np.stack(made[1])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, k1, k2, id, n): a word's wildcards (0), distinct deletions (1) and itself (2)."""
    for batch in batches:
        ids, counts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "n"))
        words = [w.encode("utf-32-le") for w in batch.column("word").to_pylist()]
        lengths = np.array([len(w) // 4 for w in words], np.int64)
        for n in np.unique(lengths).tolist():
            mine, block = np.flatnonzero(lengths == n), max(1, HELD_ROWS // (2 * n + 1))
            for lo in range(0, len(mine), block):
                at = mine[lo : lo + block]
                points = np.frombuffer(b"".join(words[i] for i in at.tolist()), np.uint32).reshape(len(at), n).astype(np.uint64)
                wild, gone = _hashes(points)
                keys = np.concatenate([wild, gone], axis=2).view(np.int64)
                kept = np.ones((len(at), 2 * n + 1), bool)
                kept[:, n + 1 : 2 * n] = points[:, 1:] != points[:, :-1]  # deleting a letter or its equal neighbour gives one word
                kind = np.broadcast_to(np.repeat(np.array([0, 1, 2], np.int32), [n, n, 1]), kept.shape)
                row = np.broadcast_to(at[:, None], kept.shape)[kept]
                yield pa.RecordBatch.from_arrays([pa.array(kind[kept]), pa.array(keys[0][kept]), pa.array(keys[1][kept]), pa.array(ids[row]), pa.array(counts[row])], ["kind", "k1", "k2", "id", "n"])


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best): for each word that has near words, their number, and (-n, id) of the first by count, then by code points."""
    spread = words.repartition(ranges(words), "id").mapInArrow(_spread, "kind int, k1 long, k2 long, id long, n long")
    mine = F.struct((-F.col("n")).alias("k"), F.col("id").alias("id"))
    spread = spread.select((F.col("kind") > 0).alias("indel"), "k1", "k2", (F.col("kind") == 2).alias("whole"), mine.alias("mine"))
    ordered = Window.partitionBy("indel", "k1", "k2").orderBy("whole", "mine").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a wildcard group: size and two first; a deletion's: how many longer words, the first of them, and the word itself if there is one (last)
    seen = spread.select("*", F.count(F.lit(1)).over(ordered).alias("size"), F.first("mine").over(ordered).alias("first"), F.nth_value("mine", 2).over(ordered).alias("second"), F.max("whole").over(ordered).alias("any_whole"), F.last("mine").over(ordered).alias("last"))
    seen = seen.where("size > 1 and (not indel or any_whole)")
    shorter = F.col("indel") & ~F.col("whole")
    n_near = F.when(shorter, 1).otherwise(F.col("size") - 1).alias("n_near")
    best = F.when(shorter, F.col("last")).when(~F.col("indel") & (F.col("first") == F.col("mine")), F.col("second")).otherwise(F.col("first")).alias("best")
    return seen.select(F.col("mine")["id"].alias("id"), n_near, best).groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of (id, form): where the forms of each id end. Followed lengths double in each round."""
    found = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("id").alias("root"), F.col("root").alias("further"))
        found = stored(found.join(ahead, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not found.where("moved").limit(1).count():
            return found.select("id", "root")
        found = found.select("id", "root")


def spelling_groups(docs: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the vocabulary of docs (doc_id, text)."""
    words = stored(vocabulary(docs, min_count), "vocabulary")
    near = words.join(near_words(words), "id", "left")
    has_form = F.coalesce(-F.col("best")["k"] >= F.col("n") * ratio, F.lit(False))
    near = stored(near.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has_form, F.col("best")["id"]).alias("form_id"), F.when(has_form, -F.col("best")["k"]).alias("form_n")), "near")
    ends = roots(near.where("form_id is not null").select("id", F.col("form_id").alias("form")))
    name = lambda i, c: words.select(F.col("id").alias(i), F.col("word").alias(c))
    out = near.join(ends.withColumnRenamed("root", "root_id"), "id", "left").join(name("form_id", "form"), "form_id", "left").join(name("root_id", "root"), "root_id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
