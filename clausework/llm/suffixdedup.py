"""Removal of repeated passages by suffix order and previous/next matches, for passages of ``min_bytes`` or more.

A byte is repeated if a string of ``min_bytes`` bytes that covers it also starts elsewhere. Suffixes cut to that length are
the unit: in suffix order, the longest string of a suffix that also starts earlier is the longer of its common prefixes with
the nearest suffixes before and after it that stand at smaller positions (``previous_factors``). A suffix whose longest
previous factor has all ``min_bytes`` bytes is a later copy, one whose longest next factor has them has a later copy. One
global suffix array does not distribute, so suffixes are dealt to buckets that keep every match together:

* each suffix is owned by its anchor, the k-gram with the least hash among those inside its ``min_bytes`` bytes (leftmost
  of equals). Equal suffixes have equal anchors at equal distance. Neighbouring suffixes with one anchor form a run of at
  most ``min_bytes - K + 1`` suffixes, one row ``(anchor hash, hash of the run's bytes, text, place)``;
* runs with equal hashes (128 bits: the anchor's and the run's) are one kind. The first and the last run of each kind are
  compared byte by byte once and, if equal, are one string with two places, repeated in all the kind's runs; hashes alone
  remove nothing. An anchor's kinds are sorted: their suffixes, their common prefixes and their longest previous and next
  factors. An anchor with more than ``CROWD`` kinds is not gathered in one task: its suffixes are grouped by their bytes
  instead, first and last place of each, which says the same.

Everything before the sort is joins and aggregations that combine before their shuffles, so neither a frequent anchor nor
a frequent passage meets in one task.

Copies of a whole text are one text here, ordered by its least doc_id; the runs found for that text are joined back to all
its copies. Only rows that repeat both doc_id and text are known by the text's hashes alone, as they have no places of their own.

Defined results: null text counts as empty; texts shorter than ``min_bytes`` lose nothing; null doc_id comes first in
order; rows that repeat a doc_id are documents of their own; an empty table gives an empty result. Further columns of the
input are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .cluster import maybe_broadcast, stored

MIN_BYTES = 200
#: Length of the k-grams that anchor suffixes; less than half of min_bytes keeps anchors rare.
K = 64
#: Suffixes that one sort takes at a time.
SORT_ROWS = 150_000
#: Kinds of runs of one anchor above which its suffixes are looked up by their hashes, over all tasks, instead of sorted in one.
CROWD = 5_000
_NULL_ID = -(1 << 63)
#: A run's place is its start and, in the low bits, how many suffixes it has.
SIZE_BITS = 20
_SIZE = (1 << SIZE_BITS) - 1


def anchor_runs(data: np.ndarray, offsets: np.ndarray, min_bytes: int, k: int) -> tuple[np.ndarray, ...]:
    """(row, start in row, suffixes, anchor hash, hash of the run's bytes) of every run of suffixes with one anchor."""
    none = np.zeros(0, np.int64)
    w, n = min_bytes - k + 1, len(data)
    if n < min_bytes:
        return none, none, none, none, none
    hashes = X.Hashes(data)
    at = np.arange(n - k + 1)
    h = hashes.of(at, at + k)
    bits = int(n).bit_length()
    mask = np.uint64((1 << bits) - 1)
    ranked = (h & ~mask) | at.astype(np.uint64)  # the least hash; of equals the leftmost
    padded = np.full(-(-len(ranked) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(ranked)] = ranked
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - min_bytes + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[starts]
    starts = starts[starts + min_bytes <= offsets[row + 1]]
    if not len(starts):
        return none, none, none, none, none
    anchor = (np.minimum(behind[starts], ahead[starts + w - 1]) & mask).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(starts)))
    lo, p = starts[first], anchor[first]
    content = X.mix(hashes.of(lo, lo + size - 1 + min_bytes) + (p - lo).astype(np.uint64))
    r = row[lo]
    return r, lo - offsets[r], size, h[p].view(np.int64), content.view(np.int64)


def _anchors(min_bytes: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = X.utf8(batch.column("text"))
            key = batch.column("k1").to_numpy(zero_copy_only=False)
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            for lo, _, part, at in X.slices(data, offsets):
                r, start, size, h, c = anchor_runs(part, at, min_bytes, k)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c), pa.array(key[lo + r]), pa.array((start << SIZE_BITS) + size), pa.array(doc[lo + r])], ["h", "c", "k1", "at", "doc"])

    return run


#: A run to sort, of the kind (h, c), its first or ``last``; of a crowded anchor, one suffix of it, ``off`` bytes behind its start.
_CUT = "h long, c long, last boolean, crowded boolean, doc long, k1 long, at long, off long, bytes binary"


def _cut(min_bytes: int):
    """Rows of ``_CUT`` out of the texts that hold the runs: a run's bytes, or each suffix's first min_bytes bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = X.utf8(batch.column("text"))
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                k, d = batch.column("k1")[i].as_py(), batch.column("doc")[i].as_py()
                whole = data[offsets[i] : offsets[i + 1]].tobytes()
                rows = []
                for r in runs:
                    lo, size = r["at"] >> SIZE_BITS, r["at"] & _SIZE
                    parts = [(x, whole[lo + x : lo + x + min_bytes]) for x in range(size)] if r["crowded"] else [(0, whole[lo : lo + size - 1 + min_bytes])]
                    rows += [{**r, "doc": d, "k1": k, "off": x, "bytes": cut} for x, cut in parts]
                yield pa.RecordBatch.from_pylist(rows, _CUT_TYPES)

    return run


_CUT_TYPES = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("last", pa.bool_()), ("crowded", pa.bool_()), ("doc", pa.int64()), ("k1", pa.int64()), ("at", pa.int64()), ("off", pa.int64()), ("bytes", pa.binary())])


def previous_factors(position: list[int], lcp: list[int]) -> list[int]:
    """Of each suffix, in suffix order, the length of its longest string that also starts at a smaller position.

    ``lcp[i]`` is the common prefix of suffixes i - 1 and i. A stack holds suffixes of rising positions, each with its common
    prefix with the one below, its previous smaller position; the suffix that takes one off is its next smaller position.
    """
    n = len(position)
    out, stack = [0] * n, []
    for i in range(n + 1):
        p, shared = (position[i], lcp[i]) if i < n else (None, 0)
        while stack and (p is None or stack[-1][0] > p):
            _, below, top = stack.pop()
            out[top] = below if below > shared else shared
            if below < shared:
                shared = below
        if i < n:
            stack.append((p, shared if stack else 0, i))
    return out


def suffix_matches(windows: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(longest previous, longest next factor) of rows of ``windows`` (n x length bytes) in positions ``order``, both cut to length.

    A longest next factor is a longest previous one with positions counted from the end.
    """
    n, length = windows.shape
    by_position = np.argsort(order, kind="stable")
    w = np.ascontiguousarray(windows[by_position])
    suffixes = np.argsort(w.view(f"S{length}").ravel(), kind="stable")
    w = w[suffixes]
    differ = w[1:] != w[:-1]
    lcp = [0, *np.where(differ.any(axis=1), differ.argmax(axis=1), length).tolist()][:n]
    back, ahead = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = by_position[suffixes]
    position = order[at]
    back[at] = previous_factors(position.tolist(), lcp)
    ahead[at] = previous_factors((-position).tolist(), lcp)
    return back, ahead


#: Suffixes ``lo`` to ``hi`` of a run that repeat; ``earlier``: an equal one stands before.
_FOUND = "h long, c long, last boolean, k1 long, doc long, at long, lo long, hi long, earlier boolean"


def _sorted_runs(min_bytes: int):
    names = ("h", "c", "last", "k1", "doc", "at")

    def emit(held: list[pa.Table]) -> pa.RecordBatch:
        """Suffix order over whole anchors' runs; rows of ``_FOUND``."""
        table = pa.concat_tables(held)
        own = {n: table.column(n).to_numpy() for n in names}
        place = np.lexsort((own["at"], own["k1"], own["doc"]))
        same = np.zeros(len(place), bool)  # rows that repeat a document have the same places
        same[1:] = (own["at"][place][1:] == own["at"][place][:-1]) & (own["k1"][place][1:] == own["k1"][place][:-1]) & (own["doc"][place][1:] == own["doc"][place][:-1])
        place = place[~same]
        own = {n: v[place] for n, v in own.items()}  # in order of places, so a row's number is its rank
        blocks = table.column("bytes")
        blocks = [blocks[i].as_py() for i in place.tolist()]
        # first and last run of a kind whose bytes are the same are one string with two places
        kind = np.lexsort((own["last"], own["c"], own["h"]))
        one, two = kind[:-1], kind[1:]
        pair = np.flatnonzero((own["h"][one] == own["h"][two]) & (own["c"][one] == own["c"][two]))
        pair = pair[[blocks[one[i]] == blocks[two[i]] for i in pair.tolist()]] if len(pair) else pair
        twice, again = np.zeros(len(place), bool), np.zeros(len(place), bool)
        twice[one[pair]], again[two[pair]] = True, True
        # a run's own suffixes differ, as they have one anchor at different distances: a string alone needs no order
        kept = np.flatnonzero(~again)
        _, group, n = np.unique(own["h"][kept], return_inverse=True, return_counts=True)
        alone = n[group] == 1
        sizes = own["at"][kept] & _SIZE
        member = np.repeat(np.arange(len(kept)), sizes)
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        back, ahead = np.zeros(len(member), bool), twice[kept][member]
        some = np.flatnonzero(~alone[member])
        if len(some):
            held_by = np.flatnonzero(~alone)
            text = np.frombuffer(b"".join(blocks[i] for i in kept[held_by]), np.uint8)
            base = np.zeros(len(kept), np.int64)
            base[held_by] = np.concatenate([[0], np.cumsum(sizes[held_by] - 1 + min_bytes)])[:-1]
            starts = base[member[some]] + inner[some]
            position = (kept[member[some]] << SIZE_BITS) + inner[some]
            view = np.lib.stride_tricks.sliding_window_view(text, min_bytes)
            parts = [np.arange(len(some))]
            if len(some) > 2 * SORT_ROWS:  # one large group: suffixes with the same two first bytes at a time
                lead = text[starts].astype(np.int64) * 256 + text[starts + 1]
                parts = [np.flatnonzero(lead == v) for v in np.unique(lead)]
            for part in parts:
                b, a = suffix_matches(view[starts[part]], position[part])
                back[some[part]] = b >= min_bytes
                ahead[some[part]] |= a >= min_bytes
        hit = np.flatnonzero(back | ahead)
        m, off, earlier = member[hit], inner[hit], back[hit]
        edge = np.ones(len(hit), bool)
        edge[1:] = (m[1:] != m[:-1]) | (off[1:] != off[:-1] + 1) | (earlier[1:] != earlier[:-1])
        lo = np.flatnonzero(edge)
        hi = np.append(lo[1:], len(hit)) - 1 if len(hit) else lo
        later = np.flatnonzero(again)
        rows = np.concatenate([kept[m[lo]], later])
        columns = [pa.array(own[n][rows]) for n in names]
        spans = [np.concatenate([off[lo], np.zeros(len(later), np.int64)]), np.concatenate([off[hi], (own["at"][later] & _SIZE) - 1]), np.concatenate([earlier[lo], np.ones(len(later), bool)])]
        return pa.RecordBatch.from_arrays([*columns, *map(pa.array, spans)], [*names, "lo", "hi", "earlier"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for table in X.groups(batches, "h"):
            held.append(table.select([*names, "bytes"]))
            size += table.num_rows * 70
            if size >= SORT_ROWS:
                yield emit(held)
                held, size = [], 0
        if held:
            yield emit(held)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of repeated suffixes' runs, (start, end, earlier), to fewest runs: ``every`` and ``later`` as pairs of ints."""
    for batch in batches:
        every, later = [], []
        for runs in batch.column("runs").to_pylist():
            every.append(_joined([(r["start"], r["end"]) for r in runs]))
            later.append(_joined([(r["start"], r["end"]) for r in runs if r["earlier"]]))
        yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("doc"), pa.array(every, pa.list_(pa.int64())), pa.array(later, pa.list_(pa.int64()))], ["k1", "doc", "every", "later"])


def _joined(runs: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1] + 1:
            out[-1] = max(out[-1], hi)
        else:
            out += [lo, hi]
    return out


def repeated_suffixes(docs: DataFrame, min_bytes: int = MIN_BYTES, k: int = K, crowd: int = CROWD) -> DataFrame:
    """(k1, k2, copies, alone, doc, every, later) of texts that repeat: keys of the text, its rows, whether they have one doc_id, the least, and the runs
    [start, end, start, end, ...] of its repeated suffixes: all of them, and those with an earlier occurrence."""
    if min_bytes - k + 1 > _SIZE:
        raise ValueError(f"passages of more than {_SIZE + k - 1} bytes are not supported")
    keyed = _keyed(docs)
    texts = keyed.groupBy("k1", "k2").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies"), (F.min("doc") == F.max("doc")).alias("alone"))
    long = keyed.where(F.octet_length("text") >= min_bytes).select("text", "k1", "doc")
    rows = stored(long.mapInArrow(_anchors(min_bytes, k), "h long, c long, k1 long, at long, doc long"), "runs")
    # anchors that stand more than once, and whether in runs of several kinds; then only their runs
    anchors = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), (F.min("c") < F.max("c")).alias("mixed")).where("n > 1").select("h", "mixed")
    anchors = stored(anchors, "repeated")  # a table of its own, so that Spark can split the join at a frequent anchor
    place = F.struct("doc", "k1", "at")
    shared = stored(rows.join(anchors, "h").select("h", "c", "mixed", place.alias("place")), "anchors")
    kinds = shared.groupBy("h", "c", "mixed").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    kinds = stored(kinds.where("mixed or first <> last"), "kinds")
    # the first and the last run of each kind are sorted, or looked up suffix by suffix where an anchor has too many kinds
    crowded = kinds.where("mixed").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("h", F.lit(True).alias("crowded"))
    one = lambda place, last: F.struct(F.col(place).alias("place"), F.lit(last).alias("last"))
    both = F.when(F.col("first") == F.col("last"), F.array(one("first", False))).otherwise(F.array(one("first", False), one("last", True)))
    chosen = kinds.join(crowded, "h", "left").select("h", "c", F.coalesce("crowded", F.lit(False)).alias("crowded"), F.inline(both))
    lists = chosen.groupBy("place.k1", "place.doc").agg(F.collect_list(F.struct("h", "c", "last", "crowded", "place.at")).alias("runs"))
    # a merge join at every size: the lists grow with the texts, so a broadcast would not last
    cut = long.join(lists.hint("merge"), ["k1", "doc"]).select("k1", "doc", "text", "runs").mapInArrow(_cut(min_bytes), _CUT)
    cut = stored(cut, "cut")
    ordered = cut.where("not crowded").repartition("h").sortWithinPartitions("h")
    found = ordered.mapInArrow(_sorted_runs(min_bytes), _FOUND)
    suffix = F.struct("doc", "k1", (F.shiftright("at", SIZE_BITS) + F.col("off")).alias("start"))
    single = cut.where("crowded").withColumn("place", suffix)
    ends = stored(single.groupBy("bytes").agg(F.min("place").alias("from"), F.max("place").alias("to")).where("from <> to").select("bytes", "from"), "ends")
    looked_up = single.join(ends, "bytes").select("h", "c", "last", "k1", "doc", "at", F.col("off").alias("lo"), F.col("off").alias("hi"), (F.col("place") > F.col("from")).alias("earlier"))
    found = stored(found.unionByName(looked_up), "found")
    start = F.shiftright("at", SIZE_BITS)
    span = lambda lo, hi: [(start + lo).alias("start"), (start + hi).alias("end"), "earlier"]
    firsts = found.where("not last").select("k1", "doc", *span(F.col("lo"), F.col("hi")))
    # what holds of a kind's last run holds of all but its first; suffixes that all repeat are one span again
    size = F.first(F.col("at").bitwiseAND(_SIZE)).alias("size")
    spans = found.where("last").groupBy("h", "c").agg(F.collect_set(F.struct("lo", "hi", "earlier")).alias("spans"), size)
    whole = (F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["hi"] - x["lo"] + 1) == F.col("size")) & F.forall("spans", lambda x: x["earlier"])
    one_span = F.array(F.struct(F.lit(0).cast("long").alias("lo"), (F.col("size") - 1).alias("hi"), F.lit(True).alias("earlier")))
    spans = spans.select("h", "c", F.when(whole, one_span).otherwise(F.col("spans")).alias("spans"))
    repeated = stored(spans.join(kinds.select("h", "c", "first"), ["h", "c"]), "repeated_kinds")
    members = shared.join(repeated, ["h", "c"]).where("place <> first").select("place.k1", "place.doc", "place.at", F.inline("spans"))
    others = members.select("k1", "doc", *span(F.col("lo"), F.col("hi")))
    runs = firsts.unionByName(others).groupBy("k1", "doc").agg(F.collect_list(F.struct("start", "end", "earlier")).alias("runs"))
    runs = runs.mapInArrow(_merge, "k1 long, doc long, every array<long>, later array<long>")
    return texts.join(runs, ["k1", "doc"], "left").where("copies > 1 or every is not null")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), F.coalesce("doc_id", F.lit(_NULL_ID)).cast("long").alias("doc"))


def byte_spans(n: int, suffixes: list[int] | None, min_bytes: int) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of the bytes that the suffixes' first min_bytes bytes cover, in a text of n bytes."""
    out: list[list[int]] = []
    for lo, hi in zip(suffixes[::2], suffixes[1::2], strict=True) if suffixes else ():
        hi = min(hi + min_bytes, n)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def substring_dedup(docs: DataFrame, min_bytes: int = MIN_BYTES, keep_first: bool = True, digest: bool = False, k: int = K, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, and spans array<struct<start, end>> with kept binary, or kept_sha256).

    keep_first: bytes of a passage's first occurrence (by least doc_id of the text, then place) stay; else all go.
    digest: the kept bytes' SHA-256 instead of the bytes.
    """
    found = stored(repeated_suffixes(docs, min_bytes, k, crowd), "repeats")
    rows = found.count()
    size = found.agg(F.sum(F.coalesce(F.size("every"), F.lit(0)) * 16 + 64)).first()[0] if rows else 0
    joined = _keyed(docs).join(maybe_broadcast(found.withColumnRenamed("doc", "least"), 1, int(size or 0)), ["k1", "k2"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = X.utf8(batch.column("text"))
            whole = data.tobytes()
            out: dict[str, list] = {"n": [], "gone": [], "spans": [], "kept": []}
            columns = [batch.column(c).to_pylist() for c in ("doc", "least", "copies", "alone", "every", "later")]
            for i, (doc, least, copies, alone, every, later) in enumerate(zip(*columns, strict=True)):
                lo, hi = int(offsets[i]), int(offsets[i + 1])
                n = hi - lo
                if n >= min_bytes and alone and copies > 1 and not keep_first:
                    spans = [(0, n)]
                else:
                    spans = byte_spans(n, later if keep_first and doc == least else every, min_bytes)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(whole[lo + at : lo + a])
                    at = b
                kept.append(whole[lo + at : hi])
                out["n"].append(n)
                out["gone"].append(sum(b - a for a, b in spans))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
                out["kept"].append(b"".join(kept))
            columns = [batch.column("doc_id"), pa.array(out["n"], pa.int64()), pa.array(out["gone"], pa.int64()), pa.array([len(s) for s in out["spans"]], pa.int64())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans"]
            if digest:
                columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in out["kept"]]))
                names.append("kept_sha256")
            else:
                columns += [pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(out["kept"], pa.binary())]
                names += ["spans", "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digest else "spans array<struct<start: long, end: long>>, kept binary")
    return joined.select("doc_id", "text", "doc", "least", "copies", "alone", "every", "later").mapInArrow(run, schema)
