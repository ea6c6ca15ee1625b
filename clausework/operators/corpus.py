"""Blocks to clauses, searchable text, and the relevance and scope filters.

Order is a column (``ord``), never the order of rows. A document is the unit of every window here.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..schema import SpecConfig
from .automaton import matched

TABLE = "[TABLE]\n"


def document_blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines of a text column as paragraph blocks; a line of the form ``number<tab>title`` or ``# title`` is a heading."""
    lines = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.posexplode(F.split(text, "\n", -1)).alias("ord", "text"))
    level = F.when(F.rlike("text", F.lit(r"^[0-9A-Za-z]+(\.[0-9A-Za-z]+)*\t")), F.size(F.split(F.substring_index("text", "\t", 1), r"\."))).when(F.startswith("text", F.lit("# ")), F.lit(1))
    return lines.select("doc_id", "ord", F.lit("p").alias("kind"), F.when(level.isNotNull(), F.concat(F.lit("Heading "), level)).otherwise("Normal").alias("style"), level.cast("int").alias("level"), F.regexp_replace("text", "^# ", "").alias("text"))


def fold_clauses(blocks: DataFrame, spec: Column | None = None, version: Column | None = None, last_wins: bool = False, base: str = "_") -> DataFrame:
    """Clauses of ordered blocks (doc_id, ord, kind, style, level, text; a table's text is already flattened).

    A non-empty heading opens a clause: ``number<tab>title`` with a number that starts with a letter or digit is keyed by
    the number, any other by the last numbered key (``_`` if none), a slash and its title. Everything else goes to the
    clause that is open, ``_preamble`` before any. A key that comes again keeps its first title and level, and its text
    goes on; with last_wins a key that comes again starts anew instead, and only its last text is kept. Parents that are
    no clauses become null. ``base`` is the key above unnumbered headings before any numbered one.
    """
    spec, version = (F.lit(None).cast("string") if c is None else c for c in (spec, version))
    t = X.strip(F.col("text"))
    heading = (F.col("kind") == "p") & F.col("level").isNotNull() & (t != "")
    tabbed = F.contains(t, F.lit("\t"))
    number = F.when(tabbed, X.strip(F.substring_index(t, "\t", 1))).otherwise("")
    title = X.strip(F.when(tabbed, F.substring(t, F.instr(t, "\t") + 1, F.length(t))).otherwise(t))
    keyed = heading & F.rlike(number, F.lit(r"(?U)^[\p{L}\p{N}]"))
    marked = blocks.withColumns({"heading": heading, "keyed": keyed, "number": number, "title": title})
    past = W.partitionBy("doc_id").orderBy("ord").rowsBetween(W.unboundedPreceding, W.currentRow)
    marked = marked.withColumn("base", F.coalesce(F.last(F.when(F.col("keyed"), F.col("number")), ignorenulls=True).over(past), F.lit(base)))
    own = F.when(F.col("keyed"), F.col("number")).when(F.col("heading"), F.concat("base", F.lit("/"), "title"))
    marked = marked.withColumn("key", F.coalesce(F.last(own, ignorenulls=True).over(past), F.lit("_preamble")))
    if last_wins:
        opened = F.max(F.when(F.col("heading"), F.col("ord"))).over(W.partitionBy("doc_id", "key"))
        marked = marked.withColumn("opened", opened).where("opened is null or ord >= opened").drop("opened")
    parent = F.when(F.col("keyed"), F.when(F.contains("number", F.lit(".")), F.regexp_replace("number", r"\.[^.]*$", ""))).when(F.col("heading"), F.col("base"))
    indent = F.repeat(F.lit("   "), F.coalesce(F.regexp_extract("style", r"^B(\d+)$", 1).try_cast("int"), F.lit(0)))
    body = F.when(F.col("kind") == "t", F.when(t != "", F.col("text"))).when(~F.col("heading"), F.when(t != "", F.concat(indent, F.regexp_replace("text", r"(?U)\s+$", ""))))
    piece = F.struct("ord", (F.col("kind") == "t").alias("table"), body.alias("text"))
    first = F.struct(F.col("ord"), F.when(F.col("keyed"), F.col("number")).alias("number"), F.when(F.col("heading"), F.col("title")).otherwise("(preamble)").alias("title"), F.when(F.col("heading"), F.col("level")).otherwise(0).alias("level"), parent.alias("parent"))
    folded = marked.groupBy("doc_id", "key").agg(F.min_by(first, "ord").alias("first"), F.array_sort(F.collect_list(F.when(body.isNotNull(), piece))).alias("pieces"))
    joined = F.aggregate(
        "pieces", F.lit(""),
        lambda s, p: F.concat(s, F.when(s == "", F.when(p["table"], F.lit(TABLE)).otherwise("")).otherwise(F.when(p["table"], F.lit("\n\n" + TABLE)).otherwise("\n")), p["text"]),
    )
    tables = F.size(F.filter("pieces", lambda p: p["table"]))
    clauses = folded.select("doc_id", F.col("first.ord").alias("ord"), "key", "first.number", "first.title", "first.level", "first.parent", joined.alias("text"), tables.cast("int").alias("tables"))
    keys = clauses.select(F.col("doc_id").alias("d"), F.col("key").alias("k"))
    known = clauses.join(keys, (F.col("doc_id") == F.col("d")) & (F.col("parent") == F.col("k")), "left")
    return known.select("doc_id", spec.alias("spec"), version.alias("version"), "ord", "key", "number", "title", "level", F.col("k").alias("parent"), "text", "tables")


def document_index(clauses: DataFrame) -> DataFrame:
    return clauses.drop("text", "tables")


def children_index(clauses: DataFrame) -> DataFrame:
    """(doc_id, parent, children): child keys in order."""
    pairs = clauses.where("parent is not null").groupBy("doc_id", "parent").agg(F.array_sort(F.collect_list(F.struct("ord", "key"))).alias("c"))
    return pairs.select("doc_id", "parent", F.col("c.key").alias("children"))


def haystacks(clauses: DataFrame) -> DataFrame:
    """(doc_id, key, hay, hay_norm): a clause's title and text, then those of its direct children, in order, by line feeds."""
    own = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))
    texts = clauses.select("doc_id", "key", "parent", "ord", own.alias("own"))
    below = texts.where("parent is not null").groupBy("doc_id", F.col("parent").alias("key")).agg(F.array_sort(F.collect_list(F.struct("ord", "own"))).alias("c"))
    hay = F.concat_ws("\n", F.array(F.col("own")), F.coalesce(F.col("c.own"), F.array().cast("array<string>")))
    return texts.join(below, ["doc_id", "key"], "left").select("doc_id", "key", hay.alias("hay")).withColumn("hay_norm", X.norm_ws(F.col("hay")))


def _any_prefix(key: Column, prefixes: tuple[str, ...], strict: bool = False) -> Column:
    hits = [F.startswith(key, F.lit(p)) if not strict else (key == p) | F.startswith(key, F.lit(p.rstrip(".") + ".")) for p in prefixes]
    out = F.lit(False)
    for h in hits:
        out = out | h
    return out


def _any_term(text: Column, terms: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(text, F.lit(t.lower()))
    return out


def relevance(clauses: DataFrame, cfg: SpecConfig, strict_prefix: bool = False) -> DataFrame:
    """clauses with kept, by_structure and reason: the first rule that applies decides.

    Dropped prefixes; the title void; no text; kept prefixes; any actor's term and none of the others'. A prefix is plain
    text unless strict_prefix, so 5.1 also keeps 5.10.
    """
    key, title = F.col("key"), X.strip(F.coalesce("title", F.lit("")))
    text = F.lower(F.concat(title, F.lit("\n"), F.coalesce("text", F.lit(""))))
    structural = _any_prefix(key, cfg.include_prefixes, strict_prefix)
    reason = (
        F.when(_any_prefix(key, cfg.drop_prefixes), "drop-prefix").when(F.lower(title) == "void", "void").when(X.strip(F.coalesce("text", F.lit(""))) == "", "no-text")
        .when(structural, F.lit(None)).when(_any_term(text, cfg.actor_terms) & ~_any_term(text, cfg.other_terms), F.lit(None)).otherwise("not-relevant")
    )
    out = clauses.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull())
    return out.withColumn("by_structure", F.col("kept") & structural)


def relevance_report(filtered: DataFrame) -> DataFrame:
    """(measure, n): totals, kept by structure, and one row for each reason."""
    rows = F.array(F.lit("total"), F.when(F.col("kept"), "kept").otherwise("dropped"), F.when(F.col("by_structure"), "kept_by_structure"), F.concat(F.lit("reason:"), "reason"))
    return filtered.select(F.explode(rows).alias("measure")).where("measure is not null").groupBy("measure").agg(F.count(F.lit(1)).alias("n"))


def in_scope(key: Column, prefixes: str) -> Column:
    """Whether a key is one of comma-separated prefixes or stands below one (after a dot or a slash)."""
    out = F.lit(False)
    for p in (p.strip() for p in prefixes.split(",") if p.strip()):
        out = out | (key == p) | F.startswith(key, F.lit(p + ".")) | F.startswith(key, F.lit(p + "/"))
    return out


def worklist(clauses: DataFrame, limit: int | None = None) -> DataFrame:
    """The first ``limit`` clauses in order, of those the ones that are no sub-units."""
    first = clauses.orderBy("ord").limit(limit) if limit else clauses
    return first.where(~F.contains("key", F.lit("/")))


def _standing(text: str, occurrences: Iterator[tuple[int, list[tuple]]]) -> list[tuple]:
    """(item, exact) of the anchors whose pattern stands in a text; a pattern that is a tail leaves the rest to be looked for."""
    seen = {rows[0][0]: rows for _, rows in occurrences}
    return [(item, whole == pattern or whole in text) for rows in seen.values() for pattern, item, whole in rows]


def anchored(items: DataFrame, texts: DataFrame) -> DataFrame:
    """(item, key, exact) for items (item, anchor) and texts (key, hay_norm): where an anchor stands, exactly or by its ending.

    An anchor of four words or more stands wherever its last three do, a shorter one where it stands whole: one machine of
    these patterns finds all of them in one pass over the texts (``automaton``). Only an anchor that is empty stands in every
    text, and only such are joined with all.
    """
    a = F.regexp_replace(X.norm_ws(F.col("anchor")), r"^[ .;:,]+|[ .;:,]+\z", "")
    words = F.split(a, " ", -1)
    pattern = F.when(F.size(words) >= 4, F.array_join(F.slice(words, F.size(words) - 2, F.lit(3)), " ")).otherwise(a)
    patterns = items.where("coalesce(anchor, '') <> ''").select(pattern.alias("pattern"), "item", a.alias("whole")).where("whole <> ''")
    fields = [T.StructField("item", items.schema["item"].dataType), T.StructField("exact", T.BooleanType())]
    found = matched(texts.select("key", "hay_norm"), "hay_norm", patterns, _standing, fields).select("item", "key", "exact")
    empty = items.where("coalesce(anchor, '') = ''")
    return found.unionByName(empty.select("item").crossJoin(texts.select("key")).withColumn("exact", F.lit(True)))
