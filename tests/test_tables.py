"""Table functions in SQL text, and sources for spark.read.format."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from clausework.functions.kernels import chunk
from clausework.functions.tables import register_tables
from clausework.session import ship
from clausework.sources import stores
from clausework.sources.datasources import register_sources

FACT = {"subject": "a", "subject_type": "Timer", "rel": "GOVERNS", "object": "b", "object_type": "Procedure"}


def test_chunks_as_rows_of_a_lateral_join(spark):
    register_tables(ship(spark))
    texts = [(0, None), (1, ""), (2, "one line"), (3, "a b\n" * 30 + "x" * 50), (4, "ünï " * 40)]
    spark.createDataFrame(texts, "id int, text string").createOrReplaceTempView("some_texts")
    got = {}
    for r in spark.sql("SELECT id, part, chunk FROM some_texts t, LATERAL chunk_rows(t.text, 20) c").collect():
        got.setdefault(r.id, {})[r.part] = r.chunk
    assert {i: [p[k] for k in sorted(p)] for i, p in got.items()} == {i: chunk(t, 20) for i, t in texts if t is not None}
    assert spark.sql("SELECT count(*) AS n FROM chunk_rows('x', CAST(NULL AS INT))").first().n == 0
    for wrong in ("chunk_rows(1, 20)", "chunk_rows('x', 'y')", "chunk_rows('x', 0)"):
        with pytest.raises(Exception, match="must be"):
            spark.sql(f"SELECT * FROM {wrong}").collect()


def test_facts_as_rows(spark):
    register_tables(ship(spark))
    replies = [(0, None), (1, "[]"), (2, "<think>[1]</think>so " + json.dumps([FACT, {"subject": "x"}, FACT | {"anchor": "q"}])), (3, "no"), (4, "[" + json.dumps(FACT) + ', {"subj')]
    spark.createDataFrame(replies, "id int, reply string").createOrReplaceTempView("some_replies")
    rows = spark.sql("SELECT id, f.* FROM some_replies r, LATERAL fact_rows(r.reply) f ORDER BY id, pos").collect()
    assert [(r.id, r.pos, r.subject, r.anchor, r.modality) for r in rows] == [(2, 0, "a", None, "prose"), (2, 1, "a", "q", "prose"), (4, 0, "a", None, "prose")]


def docx(path, *paragraphs):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>' for s, t in paragraphs) + "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
        z.writestr("word/styles.xml", f'<w:styles xmlns:w="{w}"><w:style w:styleId="h1"><w:name w:val="heading 1"/></w:style></w:styles>')
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(out.getvalue())


def test_word_files_as_a_source_with_files_pruned_by_filters(spark, tmp_path):
    register_sources(ship(spark))
    docx(tmp_path / "a.docx", ("h1", "Title"), ("x", "text"))
    docx(tmp_path / "below" / "b.docx", ("h1", "Other"))
    every = spark.read.format("worddoc").load(str(tmp_path))
    assert sorted((r.doc_id, r.ord, r.kind, r.level, r.text) for r in every.collect()) == [("a.docx", 0, "p", 1, "Title"), ("a.docx", 1, "p", None, "text"), ("a.docx", 2, "t", None, "cell"), ("below/b.docx", 0, "p", 1, "Other"), ("below/b.docx", 1, "t", None, "cell")]
    (tmp_path / "broken.docx").write_bytes(b"no archive")
    with pytest.raises(Exception, match="zip"):
        spark.read.format("worddoc").load(str(tmp_path)).collect()
    one = spark.read.format("worddoc").load(str(tmp_path)).where((F.col("doc_id") == "below/b.docx") & (F.col("kind") == "p") & (F.col("ord") < 5))
    assert [r.text for r in one.collect()] == ["Other"]  # the broken file is never opened
    assert spark.read.format("worddoc").load(str(tmp_path)).where(F.col("doc_id").isin("a.docx", "below/b.docx")).count() == 5


def test_a_log_as_a_batch_and_as_a_stream(spark, tmp_path):
    register_sources(ship(spark))
    log = str(tmp_path / "log")
    fact = F.from_json(F.lit(json.dumps(FACT)), stores.FACT)
    append = lambda n: stores.put_append(spark.range(n * 10, n * 10 + 3).select(F.col("id").cast("string").alias("clause"), F.array(fact).alias("facts")), log, n)
    append(1)
    append(2)
    (tmp_path / "log" / "append-000000000002" / "torn.json").write_text('{"clause": "torn", "fac')
    rows = spark.read.format("replylog").load(log).collect()
    assert sorted((r.append, r.clause) for r in rows) == [(1, "10"), (1, "11"), (1, "12"), (2, "20"), (2, "21"), (2, "22")] and json.loads(rows[0].facts)[0]["subject"] == "a"

    def drain(after=0):
        query = spark.readStream.format("replylog").option("after", after).load(log).writeStream.format("parquet").option("path", str(tmp_path / f"out{after}")).option("checkpointLocation", str(tmp_path / f"cp{after}")).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(int(r.clause) for r in spark.read.parquet(str(tmp_path / f"out{after}")).collect())

    assert drain() == [10, 11, 12, 20, 21, 22]
    append(3)
    assert drain() == [10, 11, 12, 20, 21, 22, 30, 31, 32]  # goes on behind what it has read
    assert drain(after=2) == [30, 31, 32]
