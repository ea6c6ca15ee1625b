"""Text and identifier expressions. Everything here is a Column built from built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Id segments of entity types, and layers of specifications.
TYPE_SLUGS = {
    "Procedure": "procedure", "Message": "message", "InformationElement": "ie", "Timer": "timer", "State": "state",
    "Event": "event", "Condition": "condition", "Bearer": "bearer", "UEVariable": "uevar", "Capability": "capability",
    "SIPMethod": "sip-method", "SIPResponse": "sip-response", "SIPHeader": "sip-header", "Identity": "identity", "NetworkElement": "netelem",
}
SPEC_LAYERS = {"TS 38.331": "rrc", "TS 24.229": "ims"}
CONCEPT_TYPES = ("ProtocolLayer", "Stratum", "DomainRoot")
NAMESPACE = "3gpp:"


def _pairs(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def strip(c: Column) -> Column:
    """Without white space of any Unicode kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def norm_ws(c: Column) -> Column:
    """Every run of Unicode white space as one space, trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm_label(c: Column) -> Column:
    """Runs of space, hyphen and underscore as one space; trimmed; lower case."""
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)[\s\-_]+", " ")))


def norm_id(c: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 as one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug(c: Column) -> Column:
    """Runs of anything but letters and digits of ASCII as one hyphen, none at the ends; case stays."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")


def name_of(entity_id: Column) -> Column:
    return F.substring_index(entity_id, "/", -1)


def bucket_of(entity_id: Column) -> Column:
    parts = F.split(entity_id, "/", -1)
    return F.when(F.size(parts) >= 2, F.get(parts, F.size(parts) - 2)).otherwise("(none)")


def bare_name(entity_id: Column, type_words: list[str]) -> Column:
    """The last segment without a leading word that only repeats a type."""
    words = "|".join(sorted({w.lower().replace("-", r"\-") for w in type_words}, key=lambda w: (-len(w), w)))
    return F.regexp_replace(name_of(entity_id), rf"^(?i:{words})[-_ ]+", "")


def canonical_id(kind: Column, label: Column, spec: Column | None = None, concept: Column | None = None) -> Column:
    """Content-derived id: namespace, layer of the specification (x if unknown), type segment, slug of the label."""
    spec = F.lit(None).cast("string") if spec is None else spec
    concept = F.lit(None).cast("string") if concept is None else concept
    layer = F.coalesce(F.element_at(_pairs(SPEC_LAYERS), spec), F.lit("x"))
    segment = F.coalesce(F.element_at(_pairs(TYPE_SLUGS), kind), F.lower(kind))
    base = F.lower(F.when(F.startswith(concept, F.lit("C_")), F.substring(concept, 3, 1 << 20)).otherwise(slug(label)))
    return (
        F.when(kind.isin(*CONCEPT_TYPES), F.concat(F.lit(f"{NAMESPACE}concept/"), base))
        .when(kind == "Release", F.concat(F.lit(f"{NAMESPACE}release/"), label))
        .otherwise(F.concat(F.lit(NAMESPACE), layer, F.lit("/"), segment, F.lit("/"), slug(label)))
    )


def relation_id(kind: Column, src: Column, dst: Column) -> Column:
    """Type and the last segments of both endpoints; endpoints of other types or layers with equal names coincide."""
    return F.concat(F.lit("rel:"), kind, F.lit(":"), name_of(src), F.lit(":"), name_of(dst))


def release_of(version: Column) -> Column:
    return F.concat(F.lit("Rel-"), F.split_part(version, F.lit("."), F.lit(1)).try_cast("int").cast("string"))


def heading_level(style: Column) -> Column:
    """N of a style ``Heading N`` or ``HN``; null otherwise."""
    named = F.regexp_extract(style, r"^Heading\S*\s+(\d+)(?:\s|$)", 1).try_cast("int")
    return F.when(F.startswith(style, F.lit("Heading")), named).otherwise(F.regexp_extract(style, r"^H(\d)$", 1).try_cast("int"))


def table_text(rows: Column) -> Column:
    """Cells of array<array<string>>: trimmed, on one line each, joined by `` | ``; rows by line feeds."""
    return F.array_join(F.transform(rows, lambda r: F.array_join(F.transform(r, lambda c: F.replace(strip(F.coalesce(c, F.lit(""))), F.lit("\n"), F.lit(" "))), " | ")), "\n")


def anchor_in(hay: Column, anchor: Column) -> Column:
    """Whether normalised text holds an anchor: as it is, or what is left after leading words while three words remain.

    Any longer ending contains the last three words, so testing those decides all of them at once.
    """
    a = F.regexp_replace(norm_ws(anchor), r"^[ .;:,]+|[ .;:,]+\z", "")
    words = F.split(a, " ", -1)
    tail = F.array_join(F.slice(words, F.greatest(F.lit(1), F.size(words) - 2), F.lit(3)), " ")
    held = ((a != "") & F.contains(hay, a)) | ((F.size(words) >= 4) & F.contains(hay, tail))
    return F.when(F.coalesce(anchor, F.lit("")) == "", F.lit(True)).otherwise(held)


def located(anchor: Column, text: Column) -> Column:
    """(start, length) of an anchor in a text, from 1; null if it is not there.

    Without the marks around it, an anchor is looked for as it is, then by its longest ending of three words or more, then
    by its first 40 characters.
    """
    a = F.regexp_replace(anchor, r"^[ .;:,]+|[ .;:,]+\z", "")
    words = F.split(a, " ", -1)
    n = F.size(words)
    endings = F.when(n > 3, F.transform(F.sequence(F.lit(2), F.greatest(n - 2, F.lit(2))), lambda i: F.array_join(F.slice(words, i, n), " ")))
    shorter = F.concat(F.coalesce(endings, F.array().cast("array<string>")), F.array(F.substring(a, 1, 40)))
    hit = F.when(F.contains(text, a), a).otherwise(F.get(F.filter(shorter, lambda s: F.contains(text, s)), F.lit(0)))
    return F.when((a != "") & hit.isNotNull(), F.struct(F.position(hit, text).alias("start"), F.char_length(hit).alias("length")))


def word_in(text: Column, term: str) -> Column:
    """Whether a literal term stands in text between characters that are no ASCII letters, digits or underscores."""
    quoted = "".join("\\" + c if not c.isalnum() and c != "_" else c for c in term)
    return F.rlike(text, F.lit(f"(^|[^A-Za-z0-9_]){quoted}([^A-Za-z0-9_]|$)"))


def truncated(c: Column, n: int = 60) -> Column:
    c = F.coalesce(c, F.lit(""))
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n - 1), F.lit("…"))).otherwise(c)


def attributes(c: Column) -> Column:
    """``k: v`` as a map of one entry, other text as a note, nothing as an empty map."""
    parts = F.split(c, ": ", 2)
    empty = F.create_map().cast("map<string,string>")
    return F.when(F.coalesce(c, F.lit("")) == "", empty).when(F.contains(c, F.lit(": ")), F.create_map(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).otherwise(F.create_map(F.lit("note"), c))


def duration(seconds: Column) -> Column:
    """Seconds as ``1h 02m 03s``, ``2m 03s`` or ``3s``."""
    s = F.floor(seconds).cast("long")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.when(h > 0, F.format_string("%dh %02dm %02ds", h, m, s % 60)).when(m > 0, F.format_string("%dm %02ds", m, s % 60)).otherwise(F.format_string("%ds", s))


def strip_reasoning(c: Column, marker: str | None = None) -> Column:
    """A reply without tagged reasoning: up to the last marker if one is given, tagged blocks, and up to the last closing tag left."""
    if marker:
        at = F.size(F.split(c, F.lit("\\Q" + marker + "\\E"), -1))
        c = F.when(at > 1, F.substring_index(c, marker, -1)).otherwise(c)
    c = F.regexp_replace(c, r"(?is)<(think|thinking|reason|reasoning)\b[^>]*>.*?</\1\s*>", "")
    c = F.regexp_replace(c, r"(?is)^.*</(?:think|thinking|reason|reasoning)\s*>", "")
    return strip(c)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine of two arrays of numbers; 1 if one has no length."""
    zero = F.lit(0.0)
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), zero, lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(1.0)).otherwise(F.lit(1.0) - dot(a, b) / norms)
