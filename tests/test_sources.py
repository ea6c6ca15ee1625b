"""Stores, snapshots, logs, providers, documents and streams."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from clausework.errors import EngineError
from clausework.operators import corpus
from clausework.plans import run
from clausework.provider import facts_of, in_batches, replies, wait_before, with_retries
from clausework.schema import SpecConfig
from clausework.sources import documents, stores
from clausework.streaming import ingest

CFG = SpecConfig("TS 38.331", "19.2.0", include_prefixes=("5",), vocab=(("Timer", ("T300",)),))
HEADER = {"spec": "s", "version": "1", "model": "m", "prompt_variant": "v1", "max_clause_chars": 10, "sentinel": False}
FACT = {"subject": "T300", "subject_type": "Timer", "rel": "GOVERNS", "object": "Setup", "object_type": "Procedure", "anchor": "T300"}


@pytest.fixture
def store(tmp_path):
    clauses = {k: {"id": k, "key": k, "number": k, "title": t, "level": 3, "parent": None, "text": x, "tables": 0} for k, t, x in (("5.9", "Setup", "starts T300"), ("5.10", "Release", "stops T300"), ("5.1", "void", "x"))}
    path = tmp_path / "clauses.json"
    path.write_text(json.dumps({"spec": "TS 38.331", "version": "19.2.0", "release": "Rel-19", "clauses": clauses}, indent=1))
    return str(path)


def test_store_keeps_the_order_of_its_file(spark, store):
    rows = stores.read_store(spark, store).orderBy("ord").collect()
    assert [(r.ord, r.key, r.title) for r in rows] == [(0, "5.9", "Setup"), (1, "5.10", "Release"), (2, "5.1", "void")]


def test_run_with_a_log_goes_on_where_it_stopped(spark, store, tmp_path):
    asked = str(tmp_path / "asked")

    def provider(request):
        with open(asked, "a") as f:
            f.write(request[-1]["content"].split("\n")[1] + "\n")
        return "<think>[x]</think>" + json.dumps([FACT])

    log, snaps = str(tmp_path / "log"), str(tmp_path / "snaps")
    first = run.run(spark, store, snaps, CFG, provider, log=log, limit=1, model="m")
    assert {r.extractor for r in first.relations.collect()} == {"llm"}
    run.run(spark, store, snaps, CFG, provider, log=log, resume=True, model="m")
    assert open(asked).read().split("\n")[:-1] == ["Clause 5.9 Setup", "Clause 5.10 Release"]
    with pytest.raises(stores.HeaderMismatch):
        run.run(spark, store, snaps, CFG, provider, log=log, resume=True, model="other")
    s = stores.Snapshots(spark, snaps)
    assert s.read("entities", label="default").count() > 0 and s.read("relations", label="default").count() == 1
    assert {r.measure for r in s.read("filter").collect()} >= {"total", "kept"}
    with pytest.raises(FileNotFoundError):
        s.read("entities", label="absent")
    assert stores.Snapshots(spark, str(tmp_path / "none")).read("aliases", optional=True).count() == 0


def test_log_skips_torn_lines_and_the_last_record_holds(spark, tmp_path):
    path = tmp_path / "log"
    path.mkdir()
    lines = [json.dumps({"type": "header"} | HEADER), "", json.dumps({"clause": "a", "facts": []}), json.dumps({"clause": "b", "facts": [FACT]}), json.dumps({"clause": "a", "facts": [FACT]}), '{"clause": "c", "fac']
    (path / "part-0.json").write_text("\n".join(lines))
    head, records = stores.read_log(spark, str(path))
    stores.check_header(head, HEADER)
    assert {r.clause: len(r.facts) for r in records.collect()} == {"a": 1, "b": 1}
    with pytest.raises(stores.HeaderMismatch, match="model"):
        stores.check_header(head, HEADER | {"model": "n"})


def test_examples_and_preferred_files(spark, tmp_path):
    assert stores.read_examples(spark, str(tmp_path / "none.json")).count() == 0
    files = spark.createDataFrame([("1", "a.doc"), ("1", "b.docx"), ("2", "c.doc")], "version string, path string")
    assert {r.version: r.path for r in stores.preferred_files(files).collect()} == {"1": "b.docx", "2": "c.doc"}


def test_retries_and_batches():
    assert [wait_before(n) for n in (1, 2, 3, 4, 10)] == [2, 4, 8, 16, 30]
    for code, status, transient in (("LLM-E002", 500, True), ("LLM-E002", 503, True), ("LLM-E002", 429, True), ("LLM-E003", None, True), ("LLM-E002", 400, False), ("LLM-E002", 404, False), ("LLM-E001", None, False), ("LLM-E004", None, False)):
        assert EngineError(code, status=status).transient() == transient
    calls, waits = [], []

    def fail():
        calls.append(1)
        raise EngineError("LLM-E003", reason="down")

    with pytest.raises(EngineError, match="down"):
        with_retries(fail, 2, waits.append)
    assert len(calls) == 3 and waits == [2, 4]
    sizes = []

    def server(batch):
        if len(batch) > 3:
            raise EngineError("LLM-E002", status=413)
        sizes.append(len(batch))
        return [x * 10 for x in batch]

    assert in_batches(list(range(7)), server, 32) == [x * 10 for x in range(7)] and max(sizes) <= 3
    assert in_batches(list(range(70)), lambda b: [len(b)] * len(b), 32)[-1] == 6


def test_unreadable_replies_are_asked_for_once_more(spark):
    def provider(request):
        return "no array" if len(request) == 2 else json.dumps([FACT, {"subject": 1}])

    clauses = spark.createDataFrame([(0, "5.9", "Setup", "one\n" + "x" * 30)], "ord int, key string, title string, text string")
    got = facts_of(replies(clauses, CFG, provider, max_chars=20)).collect()
    assert [len(r.facts) for r in got] == [3]
    silent = facts_of(replies(clauses, CFG, lambda request: "never")).collect()
    assert [r.facts for r in silent] == [[]]


def test_word_files_and_pages(spark, tmp_path):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    p = lambda t, style="": f'<w:p>{f"<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>" if style else ""}<w:r>{t}</w:r></w:p>'
    body = p("<w:t>5.1</w:t><w:tab/><w:t>Title</w:t>", "h2") + p("<w:t>text</w:t>") + f"<w:tbl><w:tr><w:tc>{p('<w:t>a</w:t>')}</w:tc><w:tc>{p('<w:t>b</w:t>')}</w:tc></w:tr></w:tbl>"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
        z.writestr("word/styles.xml", f'<w:styles xmlns:w="{w}"><w:style w:styleId="h2"><w:name w:val="heading 2"/></w:style></w:styles>')
    (tmp_path / "a.docx").write_bytes(data.getvalue())
    clauses = corpus.fold_clauses(documents.read_word(spark, str(tmp_path))).collect()
    assert [(c.key, c.title, c.text, c.tables, c.level) for c in clauses] == [("5.1", "Title", "text\n\n[TABLE]\na | b", 1, 2)]
    pages = spark.createDataFrame([(1, "<h1>A &b</h1><p class=x>one <b>two</b></p><p>three")], "page_id long, html string")
    assert [(r.ord, r.level, r.text) for r in documents.page_blocks(pages).orderBy("ord").collect()] == [(0, 1, "A &b"), (1, None, "one two"), (2, None, "three")]


def test_stream_ingests_every_file_once(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    text = "5.1.1\tSetup\nstarts T300\n5.1.2\tRelease\nsee T300, as specified in 5.1.1"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(src)
    cfg = SpecConfig("TS 38.331", "19.2.0", include_prefixes=("1:", "2:"), vocab=CFG.vocab)
    ingest.ingest(ingest.read_documents(spark, src), cfg, out, check).awaitTermination()
    spark.createDataFrame([(2, text.replace("Setup", "Setup two"))], "doc_id long, text string").write.mode("append").parquet(src)
    ingest.ingest(ingest.read_documents(spark, src), cfg, out, check).awaitTermination()
    entities, _ = ingest.merged(spark, out)
    got = {r.label: len(r.defined_in) for r in entities.collect()}
    assert got["T300"] == 4 and got["Setup"] == 1 and got["Setup two"] == 1 and got["Release"] == 2


def test_windows_and_sessions(spark):
    rows = [(1, "a", "2024-01-01 00:00:00"), (1, "a", "2024-01-01 00:10:00"), (1, "b", "2024-01-02 03:00:00"), (2, "a", "2024-01-01 00:05:00")]
    events = spark.createDataFrame(rows, "user_id int, event_type string, t string").withColumn("ts", F.to_timestamp("t"))
    assert sorted(r.n for r in ingest.windowed_counts(events).collect()) == [1, 3]
    assert sorted((r.user_id, r.n) for r in ingest.sessions(events).collect()) == [(1, 1), (1, 2), (2, 1)]


def test_exports_and_progress(spark, tmp_path):
    from clausework.schema import RELATIONS
    from clausework.sources import exports

    row = (0, "r", "T", "a", "b", "prose", "high", None, {"k": "v"}, None, [], [], None, None, None)
    exports.records_json(spark.createDataFrame([row], RELATIONS), str(tmp_path / "out"))
    got = spark.read.json(str(tmp_path / "out")).first()
    assert got["from"] == "a" and got["to"] == "b"
    assert set(json.loads(exports.ontology_json())["relation_types"]["GOVERNS"]) == {"domain", "range"}
    nodes = spark.createDataFrame([("a", "<A>", "Timer", None)], "id string, label string, grp string, detail string")
    edges = spark.createDataFrame([("e", "a", "a", "X")], "id string, src string, dst string, label string")
    assert "&lt;A&gt;" in exports.view_page(nodes, edges, "t")
    with pytest.raises(ValueError, match="focus"):
        exports.view_page(nodes.union(nodes), edges, "t", most=1)
    assert exports.shareable(nodes.selectExpr("id", "'T' type", "repeat('x', 70) label")).first().label == "x" * 59 + "…"
    progress = ingest.Progress(spark, total=100)
    progress.add(20, 2.0)
    assert progress.report() == "20 rows, 10.0 rows/s, 8 s left"
