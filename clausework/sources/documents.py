"""Blocks out of word-processor files and web pages."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..schema import BLOCKS

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _text(element) -> str:
    out = []
    for node in element.iter():
        if node.tag == f"{_W}t":
            out.append(node.text or "")
        elif node.tag == f"{_W}tab":
            out.append("\t")
        elif node.tag in (f"{_W}br", f"{_W}cr"):
            out.append("\n")
    return "".join(out)


def word_blocks(data: bytes) -> list[tuple[str, str, str]]:
    """(kind, style, text) of a file's paragraphs and tables in the order of its body."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = {}
        if "word/styles.xml" in z.namelist():
            for style in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{_W}style"):
                name = style.find(f"{_W}name")
                names[style.get(f"{_W}styleId")] = name.get(f"{_W}val") if name is not None else ""
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    out = []
    for child in body:
        if child.tag == f"{_W}p":
            style = child.find(f"{_W}pPr/{_W}pStyle")
            name = names.get(style.get(f"{_W}val"), style.get(f"{_W}val")) if style is not None else "Normal"
            out.append(("p", name[:1].upper() + name[1:], _text(child)))
        elif child.tag == f"{_W}tbl":
            rows = [[_text(c) for c in r.findall(f"{_W}tc")] for r in child.findall(f"{_W}tr")]
            out.append(("t", "", "\n".join(" | ".join(c.strip().replace("\n", " ") for c in r) for r in rows)))
    return out


def read_word(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of all .docx files under a path; a file is one row, so files are the unit of parallel work."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, data in zip(frame["path"], frame["content"], strict=True):
                blocks = word_blocks(bytes(data))
                yield pd.DataFrame({"doc_id": name, "ord": range(len(blocks)), "kind": [b[0] for b in blocks], "style": [b[1] for b in blocks], "text": [b[2] for b in blocks]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", "true").load(path)
    blocks = files.select("path", "content").mapInPandas(run, "doc_id string, ord int, kind string, style string, text string")
    return blocks.withColumn("level", F.when(F.col("kind") == "p", X.heading_level(F.col("style")))).select(*[c.split()[0] for c in BLOCKS.split(", ")])


def page_blocks(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Blocks of web pages: their headings and paragraphs in order, without markup."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<(h[1-6]|p)[ >].*?</\1>|<(?:h[1-6]|p)>[^<]*"), F.lit(0))
    rows = pages.select(F.col(page_id).cast("string").alias("doc_id"), F.posexplode(found).alias("ord", "piece"))
    level = F.regexp_extract("piece", r"^<[hH]([1-6])", 1).try_cast("int")
    text = X.norm_ws(F.regexp_replace(F.col("piece"), "(?s)<[^>]*>", " "))
    return rows.select("doc_id", "ord", F.lit("p").alias("kind"), F.when(level.isNotNull(), F.concat(F.lit("Heading "), level)).otherwise("Normal").alias("style"), level.alias("level"), text.alias("text"))
