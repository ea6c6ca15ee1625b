"""Per-row kernels that no built-in function equals, as Arrow-batched functions."""

from __future__ import annotations

import difflib
import json
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

FACT_FIELDS = ("subject", "subject_type", "rel", "object", "object_type", "modality", "confidence", "anchor")
FACTS = "array<struct<" + ",".join(f"{f}:string" for f in FACT_FIELDS) + ">>"
#: A parsed reply: status parsed, salvaged or unparsable; facts is null only for the last, and empty for an empty list.
REPLY = T.StructType([T.StructField("status", T.StringType()), T.StructField("facts", T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in FACT_FIELDS]))), T.StructField("dropped", T.IntegerType())])
CONTAINED = 0.25
#: Texts that are cut to chunks as Python strings at once.
CUT_ROWS = 256


def label_distance(a: str, b: str) -> float:
    """1 - matching-blocks ratio of lower-cased labels; at most CONTAINED if the shorter is a whole word of the longer."""
    a, b = a.lower(), b.lower()
    distance = 1.0 - difflib.SequenceMatcher(None, a, b).ratio()
    inner, outer = sorted((a, b), key=len)  # stable: of equal lengths the first is the inner
    if inner and distance > CONTAINED and re.search(rf"(?<![a-z0-9]){re.escape(inner)}(?![a-z0-9])", outer):
        return CONTAINED
    return distance


@F.pandas_udf(T.DoubleType())
def lexical_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else label_distance(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def split_line(line: str, limit: int) -> list[str]:
    """Parts of at most ``limit`` characters that join to the line; cut after the last space that fits, if any."""
    parts = []
    while len(line) > limit:
        space = line.rfind(" ", 1, limit)
        at = limit if space < 0 else space + 1
        parts.append(line[:at])
        line = line[at:]
    return [*parts, line] if line else parts


def chunk(text: str, limit: int) -> list[str]:
    """Consecutive parts of at most ``limit`` characters: whole lines packed greedily, longer lines cut by split_line."""
    if limit <= 0 or len(text) <= limit:
        return [text]
    chunks: list[str] = []
    packed: str | None = None
    for line in text.split("\n"):
        joined = line if packed is None else f"{packed}\n{line}"
        if len(line) <= limit and len(joined) <= limit:
            packed = joined
            continue
        if packed is not None:
            chunks.append(packed)
            packed = None
        if len(line) > limit:
            chunks += split_line(line, limit)
        else:
            packed = line
    return chunks if packed is None else [*chunks, packed]


def chunks(limit: int):
    """A Column function: array of a text's chunks; null for null."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def cut(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        parts = [pa.array([None if t is None else chunk(t, limit) for t in texts.slice(lo, CUT_ROWS).to_pylist()], kind) for lo in range(0, len(texts), CUT_ROWS)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return cut


_TAGS = r"(?:think|thinking|reason|reasoning)"


def without_reasoning(text: str) -> str:
    """The same as the expression strip_reasoning without a marker, for use inside tasks."""
    text = re.sub(r"(?is)<(think|thinking|reason|reasoning)\b[^>]*>.*?</\1\s*>", "", text)
    return re.sub(rf"(?is)^.*</{_TAGS}\s*>", "", text).strip()


def leading_items(text: str, at: int) -> list:
    """The elements that parse as JSON from just behind an opening bracket on, up to the first that does not."""
    decoder, items = json.JSONDecoder(), []
    separators = re.compile(r"[ \t\r\n,]*")
    at = separators.match(text, at).end()
    while at < len(text) and text[at] != "]":
        try:
            item, at = decoder.raw_decode(text, at)
        except json.JSONDecodeError:
            break
        items.append(item)
        at = separators.match(text, at).end()
    return items


def read_reply(text: str | None) -> tuple[str, list | None]:
    """(status, items) of a reply without reasoning."""
    first = text.find("[") if text else -1
    if first < 0:
        return "unparsable", None
    last = text.rfind("]")
    if last > first:
        try:
            return "parsed", json.loads(text[first : last + 1])
        except json.JSONDecodeError:
            pass
    items = leading_items(text, first + 1)
    return ("salvaged", items) if items else ("unparsable", None)


def _fact(item: object) -> dict | None:
    if not isinstance(item, dict) or any(not isinstance(item.get(k), str) for k in ("subject", "subject_type", "rel", "object", "object_type")):
        return None
    fact = {k: item.get(k) for k in FACT_FIELDS}
    fact["modality"], fact["confidence"] = item.get("modality", "prose"), item.get("confidence", "low")
    return {k: v if v is None or isinstance(v, str) else json.dumps(v) for k, v in fact.items()}


@F.pandas_udf(REPLY)
def parse_reply(replies: pd.Series) -> pd.DataFrame:
    """Facts of replies; items without the five required strings are dropped and counted."""
    rows = []
    for reply in replies:
        status, items = read_reply(reply)
        facts = None if items is None else [_fact(x) for x in items]
        rows.append((status, None if facts is None else [f for f in facts if f], 0 if facts is None else sum(f is None for f in facts)))
    return pd.DataFrame(rows, columns=["status", "facts", "dropped"])
