"""SimHash fingerprints of documents, their likeness, and search within a Hamming radius. DataFrame operations only.

A text's terms are its lower-cased words. A term's hash votes with the term's weight on each of 64 bits, for 1 if its own bit
is set and against it otherwise; the fingerprint has the bits with a positive vote. Weights grow with the square of a
word's length up to ``LONGEST``, so that rare long words outvote frequent short ones. Votes are summed two bits to a long
(32 sums for 64 bits) in an ordinary aggregation that combines before its shuffle.

The next document in order of doc_id comes from windows over ranges of doc_id: each range also holds a copy of the next
range's first document, and the last one a copy of the first of all, so no window spans the whole table.

``near_fingerprints`` searches by permuted block tables: 64 bits are cut into radius + 3 blocks, and for every choice of
3 blocks there is a table keyed by those blocks. Two fingerprints within the radius differ in at most ``radius`` blocks, so
they agree in some table's key; candidates are then decided by counting bits, and a pair counts in the first table that
holds it. Only distinct fingerprints are searched, so copies never meet. A key that more than ``CROWD`` of them share is
not compared as it is: the bits outside its blocks are cut into radius + 3 blocks again, whose tables hold the same pairs
under keys of about 48 bits, so that a crowd has at most the 2^16 fingerprints that agree in those.

Defined results: null text counts as empty; a text without words has the fingerprint 0; rows with a null doc_id stand
outside the order, as if an empty document came next; rows that repeat a doc_id are in order of their texts; a single
document is its own next; an empty table gives an empty result. Further columns are not carried. Equal fingerprints are
not near each other but the same, so n_near counts other fingerprints only, and least_near is never above a row's own
doc_id; it is null where all rows within the radius have a null doc_id.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cluster import maybe_broadcast, stored

BITS = 64
LONGEST = 12
#: Rows of one range, about; a range is one window partition. Above MAX_RANGES of them ranges grow instead.
RANGE_ROWS = 4096
MAX_RANGES = 1 << 16
RADIUS = 3
#: Known fingerprints under one key above which the key is refined.
CROWD = 1000
WORD = r"[^\x20\x09-\x0D]+"
_PAIR = (1 << 32) + 1


def _weight(word: Column) -> Column:
    n = F.least(F.char_length(word), F.lit(LONGEST)) - 2
    return F.when(word.isNotNull(), F.greatest(F.lit(1), n * n)).otherwise(0).cast("long")  # greatest skips nulls


def _votes() -> list[Column]:
    return [F.sum(F.shiftrightunsigned("hash", j).bitwiseAND(F.lit(_PAIR)) * F.col("weight")).alias(f"v{j}") for j in range(32)] + [F.sum("weight").alias("votes")]


def _fingerprint() -> Column:
    bits = []
    for j in range(32):
        low, high = F.col(f"v{j}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"v{j}", 32)
        for field, bit in ((low, j), (high, j + 32)):
            bits.append(F.when(field * 2 > F.col("votes"), F.lit((1 << bit) - (1 << 64) * (bit == 63))).otherwise(F.lit(0).cast("long")))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, fp long) for rows whose ``keys`` tell them apart; rows with equal keys are voted on together."""
    words = rows.select(*keys, F.explode_outer(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))).alias("word"))
    terms = words.select(*keys, F.xxhash64("word").alias("hash"), _weight(F.col("word")).alias("weight"))
    return terms.groupBy(*keys).agg(*_votes()).select(*keys, _fingerprint().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _ranges(docs: DataFrame, range_rows: int) -> list[int]:
    """First doc_ids of ranges of about equal rows, each of which exists; the first is the least of all."""
    n = docs.where(F.col("doc_id").isNotNull()).count()
    if not n:
        return []
    parts = max(1, min(MAX_RANGES, round(n / range_rows)))
    at = [i / parts for i in range(parts)]
    got = docs.agg(F.min("doc_id").alias("least"), F.percentile_approx("doc_id", at, max(10_000, 20 * parts)).alias("bounds")).first()
    bounds = sorted({got["least"], *got["bounds"]})
    # percentiles are rounded to doubles, so they only deal ranges; what a range begins with is its least doc_id
    known = docs.where(F.col("doc_id").isNotNull())
    return sorted(r["first"] for r in known.groupBy(_range_of(F.col("doc_id"), bounds).alias("range")).agg(F.min("doc_id").alias("first")).collect())


def _range_of(value: Column, bounds: list[int]) -> Column:
    """Index of the last of ascending bounds that is not above value; looked up in two steps of about the root of their number."""
    step = max(1, round(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    upto = lambda c: F.size(F.filter(c, lambda b: b <= value))
    outer = upto(F.array(*[F.lit(p[0]) for p in parts])) - 1
    inner = F.get(F.array(*[F.array(*[F.lit(b) for b in p]) for p in parts]), outer)
    return outer * step + upto(inner) - 1


def edited_fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS, radius: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next); with ``radius`` also n_near, least_near.

    The edited text: the last floor(n_chars / 4) code points replaced by the first as many (or all) of the next document's.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = _ranges(docs, range_rows)
    own = _range_of(F.col("doc_id"), bounds) if bounds else F.lit(0)
    loose = F.pmod(F.xxhash64("text"), F.lit(max(1, len(bounds)))).cast("int") - len(bounds) - 1
    place = lambda at, guard, last: F.struct(at.cast("int").alias("range"), F.lit(guard).alias("guard"), F.lit(last).alias("last"))
    places = F.when(F.col("doc_id").isNull(), F.array(place(loose, False, False)))
    if bounds:
        opens = (own > 0) & (_range_of(F.col("doc_id") - 1, bounds) < own)
        before = F.when(opens, F.array(place(own - 1, True, False))).otherwise(F.array().cast("array<struct<range:int,guard:boolean,last:boolean>>"))
        around = F.when(F.col("doc_id") == bounds[0], F.array(place(F.lit(len(bounds) - 1), True, True))).otherwise(F.array().cast("array<struct<range:int,guard:boolean,last:boolean>>"))
        places = places.otherwise(F.concat(F.array(place(own, False, False)), before, around))
    dealt = docs.select("doc_id", "text", F.inline(places))
    order = W.partitionBy("range").orderBy("last", "doc_id", "text")
    follows = F.when(F.col("doc_id").isNotNull(), F.lead("text").over(order))
    rows = dealt.select("range", "guard", "doc_id", "text", F.row_number().over(order).alias("n"), F.coalesce(follows, F.lit("")).alias("follows"))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("follows", F.lit(1), cut)))
    none = F.lit(None).cast("string")
    both = F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("t"), none.alias("sha")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("t"), F.sha2("edited", 256).alias("sha")),
    )
    one = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t"), none.alias("sha")))
    texts = rows.select("range", "n", "guard", "doc_id", "n_chars", F.inline(F.when(F.col("guard"), one).otherwise(both)))
    prints = fingerprints(texts, ["range", "n", "guard", "doc_id", "n_chars", "which", "sha"], "t")
    pick = lambda which, c: F.max(F.when(F.col("which") == which, F.col(c)))
    prints = prints.groupBy("range", "n", "guard", "doc_id", "n_chars").agg(pick(0, "fp").alias("fp"), pick(1, "fp").alias("edited_fp"), pick(1, "sha").alias("edited_sha256"))
    after = F.lead("fp").over(W.partitionBy("range").orderBy("n"))
    prints = prints.withColumn("next_fp", F.coalesce(F.when(F.col("doc_id").isNotNull(), after), F.lit(0).cast("long"))).where(~F.col("guard"))
    found = [] if radius is None else ["n_near", "least_near"]
    if found:
        prints = with_near(prints.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp"), radius)
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", hex_fingerprint(F.col("fp")).alias("fingerprint"), hex_fingerprint(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), *found,
    )


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _tables(bits: list[int], radius: int) -> list[list[int]]:
    """The bits of each block table's key: every choice of 3 of the radius + 3 blocks that ``bits`` are cut into."""
    blocks = radius + 3
    edges = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    cut = [bits[lo:hi] for lo, hi in zip(edges, edges[1:], strict=False)]
    return [[b for block in some for b in block] for some in combinations(cut, 3)]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def near_fingerprints(wanted: DataFrame, known: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """(fp, near, distance): for each distinct fp of ``wanted``, all distinct fps of ``known`` within ``radius`` bits."""
    tables = _tables(list(range(BITS)), radius)
    masks = [_mask(t) for t in tables]
    finer = [[m | _mask(t) for t in _tables([b for b in range(BITS) if not m >> b & 1], radius)] for m in masks]
    row = lambda ms: F.array(*[F.lit(_signed(m)) for m in ms])

    def placed(df: DataFrame, name: str) -> DataFrame:
        fps = df.select("fp").where(F.col("fp").isNotNull()).distinct().withColumnRenamed("fp", name)
        keys = [F.struct(F.lit(i).alias("tab"), F.col(name).bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]
        return fps.select(name, F.inline(F.array(*keys)))

    def pairs(left: DataFrame, right: DataFrame, by: list[str], first: Column) -> DataFrame:
        distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("near")))
        met = left.join(right, by).where(distance <= radius)
        return met.where(first).select("fp", "near", distance.alias("distance"))

    differ = F.col("fp").bitwiseXOR(F.col("near"))
    is_first = lambda ms, tab: F.array_position(F.transform(ms, lambda m: differ.bitwiseAND(m) == 0), True) - 1 == F.col(tab)
    left, right = placed(wanted, "fp"), placed(known, "near")
    crowds = stored(right.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("tab", "key"), "crowds")
    n = crowds.count()
    first = is_first(row(masks), "tab")
    if not n:
        return pairs(left, right, ["tab", "key"], first)
    crowds = maybe_broadcast(crowds, n, 16)
    subs = F.get(F.array(*[row(ms) for ms in finer]), F.col("tab"))

    def refined(df: DataFrame, name: str) -> DataFrame:
        some = df.join(crowds, ["tab", "key"], "left_semi")
        return some.select(name, "tab", F.inline(F.transform(subs, lambda m, i: F.struct(i.alias("sub"), F.col(name).bitwiseAND(m).alias("sub_key")))))

    rest = pairs(left.join(crowds, ["tab", "key"], "left_anti"), right.join(crowds, ["tab", "key"], "left_anti"), ["tab", "key"], first)
    return rest.unionByName(pairs(refined(left, "fp"), refined(right, "near"), ["tab", "sub", "sub_key"], first & is_first(subs, "sub")))


def with_near(prints: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """prints (doc_id, fp, ...) with n_near, the other fingerprints within ``radius`` bits, and least_near, the least doc_id within it."""
    prints = stored(prints, "fingerprints")
    least = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    near = near_fingerprints(least.select("fp"), least.select("fp"), radius, crowd).where("distance > 0")
    n = least.count()
    found = near.join(maybe_broadcast(least.select(F.col("fp").alias("near"), F.col("least").alias("other")), n, 32), "near")
    found = found.groupBy("fp").agg(F.count(F.lit(1)).alias("n_near"), F.min("other").alias("other"))
    known = stored(least.join(found, "fp", "left").select("fp", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.least("least", "other").alias("least_near")), "near")
    return prints.join(maybe_broadcast(known, n, 40), "fp")
