"""Logs over many appends, streams of many batches, checked orders, model and vector sources."""


import pytest
from pyspark.sql import functions as F

from clausework import provider
from clausework.errors import EngineError
from clausework.operators import graphs, merging, review
from clausework.plans import catalogue
from clausework.schema import ENTITIES, Ontology, SpecConfig
from clausework.sources import stores
from clausework.streaming import ingest

CFG = SpecConfig("TS 38.331", "19.2.0")


def test_the_last_of_ten_appends_holds(spark, tmp_path):
    path, header = str(tmp_path / "log"), {k: "x" for k in stores.HEADER} | {"max_clause_chars": 1, "sentinel": False}
    for i in range(10):
        rows = spark.createDataFrame([("5.1", str(i)), (f"own {i}", str(i))], "clause string, s string").repartition(3)
        fact = F.from_json(F.to_json(F.struct(F.col("s").alias("subject"))), stores.FACT)
        stores.append_log(rows.select("clause", F.array(fact).alias("facts")), path, None if i else header)
    head, records = stores.read_log(spark, path)
    got = {r.clause: r.facts[0].subject for r in records.collect()}
    assert got == {"5.1": "9", **{f"own {i}": str(i) for i in range(10)}} and head.count() == 1


def test_streams_of_two_hundred_batches_merge_in_their_order(spark, tmp_path):
    rows = [(b, 1 << 61 if b == 7 else 5, "e", f"label {b}") for b in range(200)]
    df = spark.createDataFrame(rows, "batch long, ord long, id string, label string")
    for c in ENTITIES.split(", "):
        name, kind = c.split(" ", 1)
        if name not in df.columns and "<" not in kind:
            df = df.withColumn(name, F.lit(None).cast(kind))
    for name in ("defined_in", "observed_in"):
        df = df.withColumn(name, F.lit(None).cast(spark.createDataFrame([], ENTITIES).schema[name].dataType))
    out = str(tmp_path / "out")
    df.write.partitionBy("batch").parquet(f"{out}/entities")
    relations = df.withColumnRenamed("defined_in", "provenance")
    relations.write.partitionBy("batch").parquet(f"{out}/relations")
    for merged in ingest.merged(spark, out):
        assert [r.label for r in merged.collect()] == ["label 0"]


def test_orders_that_do_not_fit_are_errors(spark):
    parts = lambda *v: spark.range(1).select(merging.ordinal(*map(F.lit, v)).alias("o")).first().o
    assert parts(0, 1, 2) < parts(0, 2, 0) < parts(1, 0, 0) < parts(7, (1 << 40) - 1, (1 << 20) - 1)
    for wrong in ((8, 0, 0), (0, 1 << 40, 0), (0, 0, 1 << 20)):
        with pytest.raises(Exception, match="no order"):
            parts(*wrong)


def test_chains_of_many_levels_are_followed_to_their_end(spark):
    links = spark.createDataFrame([(i, i - 1 if i else None) for i in range(81)], "node long, parent long")
    assert graphs.depths(links).where("node = 80").first().depth == 80
    some = graphs.ancestors(links, spark.createDataFrame([(3,), (3,)], "node long"))
    assert sorted((r.node, r.ancestor) for r in some.collect()) == [(3, a) for a in range(4)]


def test_requests_hold_examples_types_and_the_marker(spark):
    ontology = Ontology(entity_types=(("Gizmo", None),), relation_types=(("TURNS", ("Gizmo",), ("Gizmo",)),))
    seen = []

    def source(request):
        seen.append(request)
        return "reasons [1, 2 " + provider.SENTINEL + ' [{"subject": "a", "subject_type": "Gizmo", "rel": "TURNS", "object": "b", "object_type": "Gizmo"}]'

    request = provider.messages(CFG, "5.1", "t", "x", [{"clause": "9", "text": "shown", "facts": [{"subject": "s"}]}], "v1", ontology, True)
    assert "Gizmo" in request[0]["content"] and provider.SENTINEL in request[0]["content"] and '"subject": "s"' in request[1]["content"] and "shown" in request[1]["content"]
    assert provider.SENTINEL not in provider.messages(CFG, "5.1", "t", "x")[0]["content"]
    clauses = spark.createDataFrame([(0, "5.1", "t", "x")], "ord int, key string, title string, text string")
    replied = provider.replies(clauses, CFG, source, ontology=ontology, sentinel=True)
    assert [len(r.facts) for r in provider.facts_of(replied, provider.SENTINEL).collect()] == [1]


def entities(spark):
    rows = [(0, "n/Timer/T300", "Timer", "T300", "deterministic:vocab"), (1, "n/Timer/T301", "Timer", "T301", "deterministic:vocab"), (2, "n/timer/t-300", "Timer", "t 300", "llm")]
    return spark.createDataFrame(rows, "ord long, id string, type string, label string, extractor string")


def test_vectors_and_the_fall_back_to_labels(spark):
    def embed(labels):
        if len(labels) > 1:
            raise EngineError("LLM-E002", status=413)
        return [[1.0, 0.0] if "301" not in x else [0.0, 1.0] for x in labels]

    def broken(labels):
        raise EngineError("LLM-E002", status=400)

    both = Ontology().compatible(spark)
    by = {e: review.aligned(entities(spark), both, 0.5, e).collect() for e in (embed, broken, None)}
    assert [(r.canonical_id, r.backend) for r in by[embed]] == [("n/Timer/T300", "embedding")]
    assert [(r.canonical_id, r.backend) for r in by[broken]] == [(r.canonical_id, r.backend) for r in by[None]] == [("n/Timer/T300", "difflib")]


def test_lexical_suggestions_against_brute_force(spark):
    from clausework.functions.kernels import label_distance

    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet").collect()
    got = {r.surface_id: r for r in catalogue.QUERIES["q_alias_lexical"](spark, "/root/testdata/sf0.001").collect()}
    found = 0
    for s in parts:
        near = [(label_distance(s.p_name, c.p_name), c.p_partkey) for c in parts if s.p_partkey % 2 and not c.p_partkey % 2 and s.p_brand == c.p_brand]
        assert (str(s.p_partkey) in got) == bool(near)
        if near:
            found += 1
            assert got[str(s.p_partkey)].canonical_id == str(min(near)[1]) and abs(got[str(s.p_partkey)].distance - min(near)[0]) < 1e-4
    assert found


def answers(request):
    key = request[1]["content"].split("Clause ", 1)[1].split(" ", 1)[0]
    return f'[{{"subject": "S{key}", "subject_type": "Event", "rel": "TRIGGERS", "object": "P", "object_type": "Procedure"}}, {{"subject": "P", "subject_type": "Procedure", "rel": "TRIGGERS", "object": "S{key}", "object_type": "Event"}}]'


def test_command_lines_run_resume_and_report(spark, tmp_path, capsys):
    import json

    from clausework.plans import reports, run

    clauses = {f"5.{i}": {"id": f"5.{i}", "key": f"5.{i}", "number": f"5.{i}", "title": f"Setup {i}", "level": 3, "parent": None, "text": f"text {i}", "tables": 0} for i in range(4)}
    (tmp_path / "store.json").write_text(json.dumps({"spec": "TS 38.331", "version": "19.2.0", "clauses": clauses}))
    at = ["--store", str(tmp_path / "store.json"), "--snapshots", str(tmp_path / "runs"), "--spec", "TS 38.331", "--version", "19.2.0"]
    model = ["--provider", "tests.test_runs:answers", "--log", str(tmp_path / "log"), "--model", "m"]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(run, "SpecConfig", lambda spec, version: SpecConfig(spec, version, include_prefixes=("5.",)))
        run.main([*at, "--label", "first", *model, "--limit", "2"])
        run.main([*at, "--label", "second", *model, "--resume"])
        with pytest.raises(stores.HeaderMismatch):
            run.main([*at, *model, "--resume", "--max-clause-chars", "7"])
        run.main([*at, "--label", "plain", "--dry-run", *model])
    runs = stores.Snapshots(spark, str(tmp_path / "runs"))
    count = lambda t, label: runs.read(t, label=label).count()
    assert [count("relations", x) for x in ("first", "second")] == [4, 8] and runs.read("relations", label="plain", optional=True).count() == 0
    assert stores.read_log(spark, str(tmp_path / "log"))[1].count() == 4
    common = ["--snapshots", str(tmp_path / "runs"), "--spec", "TS 38.331", "--version", "19.2.0"]
    capsys.readouterr()
    for report, more, expected in (
        ("triage", ["--label", "second"], "TRIGGERS"),
        ("compare", ["--label", "first,second"], "only_b=4"),
        ("evaluate", ["--label", "first", "--gold", "second"], "measure=recall"),
        ("align", ["--label", "second", "--rho", "0.9"], "merge"),
        ("retype", ["--label", "second", "--write-label", "retyped"], "new_type=RAISES"),
    ):
        reports.main([report, *common, *more, "--out", str(tmp_path / "report.txt")])
        shown = capsys.readouterr().out
        assert expected in shown and (tmp_path / "report.txt").read_text() == shown, (report, shown)
    assert {r.type for r in runs.read("relations", label="retyped").collect()} == {"TRIGGERS", "RAISES"}
