"""Replies kept as they come, runs committed whole, progress and metrics."""

import json

import pytest
from pyspark.sql import functions as F

from clausework.errors import EngineError, packed, unpacked
from clausework.plans import metrics, reports, run
from clausework.schema import Options, SpecConfig
from clausework.sources import stores
from clausework.sources.commits import CommitConflict
from clausework.storage import scratch
from clausework.streaming import asking

CFG = SpecConfig("TS 38.331", "19.2.0", include_prefixes=("5.",))
FACT = {"subject_type": "Event", "rel": "TRIGGERS", "object": "P", "object_type": "Procedure"}


def store_of(folder, n):
    clauses = {f"5.{i}": {"id": f"5.{i}", "key": f"5.{i}", "number": f"5.{i}", "title": f"Setup {i}", "level": 3, "parent": None, "text": f"text {i}", "tables": 0} for i in range(n)}
    (folder / "store.json").write_text(json.dumps({"spec": CFG.spec, "version": CFG.version, "clauses": clauses}))
    return str(folder / "store.json")


def source(calls, dies_at=None, error=None):
    """Answers one fact per clause, notes each call in a file, and fails from a call on."""

    def answer(request):
        import fcntl

        key = request[1]["content"].split("Clause ", 1)[1].split(" ", 1)[0]
        with open(calls, "a+") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            f.seek(0)
            if dies_at and len(f.read().splitlines()) + 1 >= dies_at:
                raise error or RuntimeError("the model is gone")
            f.write(key + "\n")
        return json.dumps([{"subject": f"S{key}", **FACT}])

    return answer


def lines(path):
    return path.read_text().splitlines()


@pytest.mark.parametrize("error", [None, EngineError("LLM-E002", status=400)])
def test_a_dying_model_leaves_its_replies_and_resume_asks_the_rest(spark, tmp_path, error):
    store, log, calls = store_of(tmp_path, 40), str(tmp_path / "log"), tmp_path / "calls"
    with pytest.raises((RuntimeError, EngineError), match="gone|400"):
        run.run(spark, store, str(tmp_path / "runs"), CFG, source(str(calls), 31, error), log=log, model="m")
    kept = {r.clause for r in stores.read_log(spark, log)[1].collect()}
    assert len(kept) == 30 and kept == set(lines(calls))  # all that was answered, nothing else
    assert stores.Snapshots(spark, str(tmp_path / "runs")).read("entities", optional=True).count() == 0
    result = run.run(spark, store, str(tmp_path / "runs"), CFG, source(str(calls)), log=log, model="m", resume=True)
    assert len(lines(calls)) == len(set(lines(calls))) == 40  # nothing is asked twice
    assert result.relations.count() == 40


def test_without_a_log_each_clause_is_asked_once(spark, tmp_path):
    calls = tmp_path / "calls"
    result = run.run(spark, store_of(tmp_path, 20), str(tmp_path / "runs"), CFG, source(str(calls)), model="m")
    assert len(lines(calls)) == 20 and result.relations.count() == 20 and result.entities.where("extractor = 'llm'").count() == 21


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    path, header = str(tmp_path / "log"), {k: "x" for k in stores.HEADER} | {"max_clause_chars": 1, "sentinel": False}
    stores.start_log(spark, path, header)
    facts = F.array().cast(f"array<{stores.FACT}>").alias("facts")
    for number in (1, 2, 2):
        stores.put_append(spark.range(number * 10, number * 10 + 5).select(F.col("id").cast("string").alias("clause"), facts), path, number)
    raw = spark.read.option("recursiveFileLookup", "true").json(path)
    assert raw.where("clause is not null").count() == 10 and stores.last_append(spark, path) == 2


def test_batches_are_bounded_and_committed_one_after_another(spark, tmp_path):
    log, sizes = str(tmp_path / "log"), []
    work = spark.range(25).select(F.col("id").alias("ord"), F.concat(F.lit("5."), "id").alias("key"), F.lit("t").alias("title"), F.lit("x").alias("text"))
    empty = F.array().cast(f"array<{stores.FACT}>")
    answer = lambda rows: rows.select(F.col("ord").alias("clause_ord"), F.col("key").alias("clause"), empty.alias("facts"), F.lit(None).cast("string").alias("error"))
    asking.ask_all(work, answer, log, batch=4, seen=lambda got, n: sizes.append((n, got.count(), stores.last_append(spark, log))))
    assert sum(s for _, s, _ in sizes) == 25 and max(s for _, s, _ in sizes) <= 8 and [a for *_, a in sizes] == [n + 1 for n, *_ in sizes]
    asking.ask_all(work.limit(0), answer, log)
    assert stores.read_log(spark, log)[1].count() == 25


def test_batches_grow_with_what_is_done(spark, tmp_path):
    log, sizes = str(tmp_path / "log"), []
    work = spark.range(2000).select(F.col("id").alias("ord"), F.concat(F.lit("5."), "id").alias("key"), F.lit("t").alias("title"), F.lit("x").alias("text"))
    empty = F.array().cast(f"array<{stores.FACT}>")
    answer = lambda rows: rows.select(F.col("ord").alias("clause_ord"), F.col("key").alias("clause"), empty.alias("facts"), F.lit(None).cast("string").alias("error"))
    asking.ask_all(work, answer, log, batch=40, seen=lambda got, n: sizes.append(got.count()))
    assert sum(sizes) == 2000 and len(sizes) < 35 and all(s <= max(40, sum(sizes[:i]) / 7) for i, s in enumerate(sizes))
    assert asking.next_batch(40, 100, 1.0, 8000) == 1000 and asking.next_batch(40, 100, 61.0, 8000) == 100


def test_errors_pack_and_unpack():
    e = unpacked(packed(EngineError("LLM-E002", status=429)))
    assert isinstance(e, EngineError) and e.transient() and str(e) == str(EngineError("LLM-E002", status=429))
    assert "ValueError: no" in str(unpacked(packed(ValueError("no"))))


def test_too_many_examples_are_an_error(spark, tmp_path):
    path = tmp_path / "examples.json"
    rows = [{"clause": f"{i:02}", "title": "t", "text": "x", "facts": []} for i in range(run.MOST_EXAMPLES)]
    path.write_text(json.dumps(rows[::-1]))
    assert [e["clause"] for e in run.shown_examples(spark, str(path))] == [r["clause"] for r in rows]
    path.write_text(json.dumps([*rows, rows[0]]))
    with pytest.raises(ValueError, match="examples"):
        run.shown_examples(spark, str(path))


def test_runs_are_committed_whole(spark, tmp_path):
    snaps = stores.Snapshots(spark, str(tmp_path / "runs"))
    rows = lambda n: spark.range(n).select(F.lit("total").alias("measure"), F.col("id").alias("n"))
    assert snaps.commit({"filter": rows(3)}, CFG, "a") == 1

    broken = rows(2).select(F.raise_error(F.lit("no disk")).cast("string").alias("measure"), "n")
    with pytest.raises(Exception, match="no disk"):
        snaps.commit({"filter": rows(9), "review": broken}, CFG, "a")
    assert snaps.read("filter", label="a").count() == 3 and snaps.read("review", label="a", optional=True).count() == 0
    snaps.write("filter", snaps.read("filter", label="a").drop("spec", "version", "run").limit(1), CFG, "a")  # from itself
    snaps.commit({"filter": rows(5)}, SpecConfig("TS 24.229", "18.1.0"), "b/c =d")
    assert snaps.read("filter", label="a").count() == 1 and snaps.read("filter", label="a", number=1).count() == 3
    assert sorted((r.spec, r.version, r.run) for r in snaps.read("filter").select("spec", "version", "run").distinct().collect()) == [("24229", "18.1.0", "b/c =d"), ("38331", "19.2.0", "a")]
    with pytest.raises(CommitConflict):
        snaps.manifests.publish(("38331", "19.2.0", "a"), {}, 1)
    with pytest.raises(FileNotFoundError):
        snaps.read("entities", label="a")


def test_retype_in_place_keeps_the_run(spark, tmp_path, capsys):
    store = store_of(tmp_path, 12)

    def backwards(request):
        key = request[1]["content"].split("Clause ", 1)[1].split(" ", 1)[0]
        return json.dumps([{"subject": "P", "subject_type": "Procedure", "rel": "TRIGGERS", "object": f"E{key}", "object_type": "Event"}])

    run.run(spark, store, str(tmp_path / "runs"), CFG, backwards, label="x", model="m")
    snaps = stores.Snapshots(spark, str(tmp_path / "runs"))
    n = snaps.read("entities", label="x").count()
    at = ["--snapshots", str(tmp_path / "runs"), "--spec", CFG.spec, "--version", CFG.version, "--label", "x"]
    reports.main(["retype", *at, "--write-label", "x"])
    assert "after=0  before=12" in "  ".join(sorted(capsys.readouterr().out.split("cat=domain-violation")[1].split("\n")[0].split()))
    assert snaps.read("entities", label="x").count() == n and {r.type for r in snaps.read("relations", label="x").collect()} == {"RAISES"}
    assert snaps.read("findings", label="x").where("cat = 'domain-violation'").count() == 0
    reports.main(["align", *at, "--recompute", "--rho", "0.99", "--write-label", "x"])
    assert "merge" in capsys.readouterr().out and snaps.read("aliases", label="x").where("proposal = 'merge'").count() > 0


def test_three_runs_are_compared_pair_by_pair(spark, tmp_path):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    entities = frame([(r, f"{r}{i}", "llm") for r in "abc" for i in range(2)], "run string, id string, extractor string")
    relations = frame([(r, "s", "GOVERNS", r, f"rel{r}", "llm", None) for r in "abc"], "run string, src string, type string, dst string, id string, extractor string, procedure_ctx string")
    text = reports.compare(entities, relations)
    assert all(f"only in one of {a} and {b}" in text for a, b in (("a", "b"), ("a", "c"), ("b", "c")))


def test_metrics_are_said_and_stored(spark, tmp_path):
    said = []
    ticks = iter(range(0, 1000, 2))
    m = metrics.RunMetrics(said.append, clock=lambda: next(ticks))
    m.begin("ask", 10)
    m.step("ask", 4)
    assert said[-1] == "ask: 4 of 10, 3 s left, 2.00 a second"
    run.run(spark, store_of(tmp_path, 6), str(tmp_path / "runs"), CFG, source(str(tmp_path / "calls")), log=str(tmp_path / "log"), model="m", metrics=metrics.RunMetrics(said.append))
    got = {(r.phase, r.measure): r.value for r in stores.Snapshots(spark, str(tmp_path / "runs")).read("metrics").collect()}
    assert got["ask", "rows"] == 6 and got["extract", "relations"] == got["extract", "relations_model"] == 6 and got["extract", "seconds"] > 0 and got["write", "findings"] == 0
    assert any(line.startswith("ask: 6 of 6") for line in said)


def test_scratch_folders_differ(spark):
    assert scratch(spark, "x") != scratch(spark, "x")
