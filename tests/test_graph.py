"""Folding, filters, extraction, merging, validation, review, comparison and history on hand-made tables."""

import random

import pytest
from pyspark.sql import functions as F

from clausework.operators import comparison, corpus, extraction, graphs, history, merging, review, validation
from clausework.plans import run
from clausework.schema import BLOCKS, CLAUSES, ENTITIES, RELATIONS, Ontology, Options, Registry, SpecConfig

CFG = SpecConfig("TS 38.331", "19.2.0", include_prefixes=("5.",), drop_prefixes=("_", "Annex"), actor_terms=("the UE shall",), other_terms=("the network shall",), vocab=(("Timer", ("T300",)), ("Message", ("RRCSetup", "RRCSetupRequest"))))
PROV = ("Rel-19", "TS 38.331", "19.2.0")


def entity(ord, id, type, label="", extractor=None, confidence=None, clause=None, anchor=None, observed=None, introduced=None, supersedes=None):
    prov = [(*PROV, clause, anchor, None, None)] if clause else []
    return (ord, id, type, label, extractor, confidence, None, prov, observed or [], introduced, None, supersedes)


def relation(ord, id, type, src, dst, confidence="high", extractor=None, clause=None, anchor=None, observed=None):
    prov = [(*PROV, clause, anchor, None, None)] if clause else []
    return (ord, id, type, src, dst, "prose", confidence, None, {}, extractor, prov, observed or [], None, None, None)


def clause(ord, key, title, level, parent, text):
    number = key if key[0].isdigit() and "/" not in key else None
    return ("TS 38.331", "19.2.0", ord, key, number, title, level, parent, text, 0)


@pytest.fixture(scope="module")
def clauses(spark):
    rows = [
        clause(0, "_preamble", "(preamble)", 0, None, "x"),
        clause(1, "5.3", "RRC control", 2, None, ""),
        clause(2, "5.3.3", "RRC connection establishment", 3, "5.3", ""),
        clause(3, "5.3.3.2", "Initiation", 4, "5.3.3", "The UE starts timer T300 and sends RRCSetupRequest, as specified in 5.3.5.1. See defined in clause 5.3.3."),
        clause(4, "5.3.5", "RRC reconfiguration parameters", 3, "5.3", ""),
        clause(5, "5.3.5.1", "General", 4, "5.3.5", "T300 is described in 5.3.3.2 and 9.9."),
        clause(6, "6.1", "Other", 2, None, "the UE shall do so"),
        clause(7, "6.2", "Other", 2, None, "the UE shall, the network shall"),
        clause(8, "6.3", "void", 2, None, "the UE shall"),
        clause(9, "Annex", "A", 1, None, "the UE shall"),
        clause(10, "5.3.3.2/sub", "sub", 4, "5.3.3.2", "T300 again"),
    ]
    return spark.createDataFrame(rows, CLAUSES).withColumn("doc_id", F.lit("d"))


def test_relevance_and_scope(spark, clauses):
    got = {r.key: r.reason for r in corpus.relevance(clauses, CFG).collect()}
    assert got == {"_preamble": "drop-prefix", "5.3": "no-text", "5.3.3": "no-text", "5.3.3.2": None, "5.3.5": "no-text", "5.3.5.1": None, "6.1": None, "6.2": "not-relevant", "6.3": "void", "Annex": "drop-prefix", "5.3.3.2/sub": None}
    report = {r.measure: r.n for r in corpus.relevance_report(corpus.relevance(clauses, CFG)).collect()}
    assert report == {"total": 11, "kept": 4, "dropped": 7, "kept_by_structure": 3, "reason:drop-prefix": 2, "reason:no-text": 3, "reason:not-relevant": 1, "reason:void": 1}
    keys = spark.createDataFrame([("5.1",), ("5.1.2",), ("5.1/x",), ("5.10",)], "key string")
    assert [r.key for r in keys.where(corpus.in_scope(F.col("key"), "5.1")).collect()] == ["5.1", "5.1.2", "5.1/x"]
    loose = SpecConfig("s", "1", include_prefixes=("5.1",))
    rows = keys.selectExpr("key", "'' title", "'t' text")
    assert corpus.relevance(rows, loose).where("kept").count() == 4 and corpus.relevance(rows, loose, strict_prefix=True).where("kept").count() == 2
    assert [r.key for r in corpus.worklist(clauses.where("ord >= 9"), 2).collect()] == ["Annex"]


def test_blocks_fold_to_clauses(spark):
    rows = [("d", 0, "p", "Normal", None, "before"), ("d", 1, "p", "Heading 1", 1, "5\tTop"), ("d", 2, "p", "B2", None, "indented "), ("d", 3, "t", "", None, "a | b"), ("d", 4, "p", "Heading 2", 2, "Unnumbered"), ("d", 5, "p", "Normal", None, "body"), ("d", 6, "p", "Heading 2", 2, "5.1.1\tDeep"), ("d", 7, "p", "Heading 2", 2, " "), ("d", 8, "p", "Heading 1", 1, "5\tAgain"), ("d", 9, "p", "Normal", None, "more")]
    shuffled = rows[:]
    random.Random(0).shuffle(shuffled)
    got = {r.key: r for r in corpus.fold_clauses(spark.createDataFrame(shuffled, BLOCKS).repartition(3)).collect()}
    assert set(got) == {"_preamble", "5", "5/Unnumbered", "5.1.1"}
    assert got["5"].title == "Top" and got["5"].text == "      indented\n\n[TABLE]\na | b\nmore" and got["5"].tables == 1
    assert got["5/Unnumbered"].parent == "5" and got["5/Unnumbered"].text == "body" and got["5/Unnumbered"].number is None
    assert got["5.1.1"].parent is None and got["_preamble"].title == "(preamble)" and got["_preamble"].level == 0


def test_extraction(spark, clauses):
    kept = corpus.relevance(clauses, CFG).where("kept")
    entities, relations = extraction.extract(clauses, kept, CFG)
    by = {r.label: r for r in entities.collect()}
    assert by["Initiation"].extractor == "deterministic:procedure"
    assert by["RRC connection establishment"].extractor == "deterministic:procedure-heading"
    assert by["RRC reconfiguration parameters"].confidence == "med" and by["RRC reconfiguration parameters"].review == "ambiguous-procedure-title"
    assert [p.clause for p in by["T300"].defined_in] == ["5.3.3.2", "5.3.5.1", "5.3.3.2/sub"] and "RRCSetup" not in by and "RRCSetupRequest" in by
    assert {(r.src.split("/")[-1], r.dst.split("/")[-1]) for r in relations.collect()} == {("Initiation", "RRC-connection-establishment")}
    result = run.build(clauses, CFG)
    assert result.findings.count() == 0 and result.warnings.count() == 0


def test_merging_equals_a_loop(spark):
    rng = random.Random(4)
    rows = []
    for o in range(300):
        prov = [(*PROV, rng.choice(["c1", "c2", None]), rng.choice(["a", "b"]), None, None) for _ in range(rng.randint(0, 3))]
        rows.append((o, f"e{rng.randint(0, 40)}", "Timer", f"l{o}", None, None, None, prov, [], None, None, None))
    expected = {}
    for r in rows:
        if r[1] not in expected:
            expected[r[1]] = (r[3], list(r[7]))
        else:
            seen = {(p[3], p[4]) for p in expected[r[1]][1]}
            expected[r[1]][1].extend(p for p in r[7] if (p[3], p[4]) not in seen)
    for parts in (1, 7):
        rng.shuffle(rows)
        got = merging.merge_records(spark.createDataFrame(rows, ENTITIES).repartition(parts), "defined_in").collect()
        assert {r.id: (r.label, [tuple(p) for p in r.defined_in]) for r in got} == expected


def test_merging_shuffles_twice(spark):
    """Records without items too keep their fields; an order may be a structure."""
    item = lambda c: ("Rel-19", None, "1", c, None, None, None)
    shape = "id string, ord struct<batch: int, ord: int>, attrs map<string, string>, provenance array<struct<release: string, spec: string, version: string, clause: string, anchor: string, curated: boolean, external: boolean>>"
    rows = [("a", (1, 0), {"x": "1"}, [item("1"), item(None)]), ("a", (0, 5), {"x": "2"}, None), ("a", (2, 0), {}, [item(None), item("2")]), ("b", (3, 3), None, [])]
    merged = merging.merge_records(spark.createDataFrame(rows, shape), "provenance")
    plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2
    got = {r.id: (tuple(r.ord), r.attrs, [p.clause for p in r.provenance]) for r in merged.collect()}
    assert got == {"a": ((0, 5), {"x": "2"}, ["1", None, "2"]), "b": ((3, 3), None, [])}


def test_facts_become_records(spark):
    fact = ("s", "Timer", "GOVERNS", "o", "Procedure", None, None)
    rows = [(1, "5.1", 0, *fact, "first"), (1, "5.1", 1, *fact, "second"), (2, "5.2", 0, *fact, "third")]
    facts = spark.createDataFrame(rows, "clause_ord long, clause string, pos int, subject string, subject_type string, rel string, object string, object_type string, modality string, confidence string, anchor string")
    entities, relations = merging.facts_to_records(facts, CFG)
    assert sorted((r.label, r.defined_in[0].anchor) for r in entities.collect()) == [("o", "second"), ("o", "third"), ("s", "second"), ("s", "third")]
    got = relations.collect()
    assert sorted(r.provenance[0].anchor for r in got) == ["first", "third"] and {(r.modality, r.confidence) for r in got} == {("prose", "low")}


def faulty(spark):
    entities = [entity(0, "x/procedure/P", "Procedure", "P"), entity(1, "x/event/E", "Event", "E"), entity(2, "x/timer/T", "Timer", "T", observed=["Rel-99"]), entity(3, "x/ie/I", "InformationElement", "I", introduced="Rel-1"), entity(4, "x/clause/C", "Clause", "C"), entity(5, "x/odd/O", "Oddity", "O")]
    relations = [
        relation(0, "r1", "TRIGGERS", "x/procedure/P", "x/event/E"), relation(1, "r2", "NOPE", "x/procedure/P", "gone"),
        relation(2, "r3", "STARTS", "lost", "x/timer/T"), relation(3, "r4", "DEFINED_IN", "x/timer/T", "5.3"),
        relation(4, "r5", "WRITES", "x/procedure/P", "x/ie/I"), relation(5, "r6", "STARTS", "x/procedure/P", "x/Timer/t"),
    ]
    relations[4] = (*relations[4][:-1], "unknown")
    return spark.createDataFrame(entities, ENTITIES), spark.createDataFrame(relations, RELATIONS)


def test_findings_messages_and_triage(spark):
    entities, relations = faulty(spark)
    found = validation.findings(entities, relations)
    rows = validation.messages(found).orderBy("rule_ord", "row_ord").collect()
    assert [(r.cat, r.id) for r in rows] == [
        ("entity-undeclared-type", "x/clause/C"), ("entity-undeclared-type", "x/odd/O"), ("relation-undeclared-type", "r2"), ("dangling-from", "r3"),
        ("dangling-to", "r4"), ("dangling-to", "r6"), ("domain-violation", "r1"), ("range-violation", "r1"),
        ("lifecycle-release", "x/timer/T"), ("lifecycle-field", "x/ie/I"), ("lifecycle-supersedes", "r5"),
    ]
    assert [r.pseudo for r in rows if r.cat == "dangling-to"] == [True, False]
    assert rows[6].message == "relation r1 (TRIGGERS): from-type Procedure not in domain ['Event']"
    assert rows[3].message == "relation r3 from unknown entity lost"
    assert [(r.type, r.n) for r in validation.reversed_edges(entities, relations).collect()] == [("TRIGGERS", 1)]
    c = validation.collateral(found, entities, relations).first()
    assert (c.violations, c.collateral, c.doubled) == (2, 0, 1)
    misses = validation.near_misses(found.where("cat like 'dangling%'"), entities, ["timer"])
    assert {r.ref: r.rule for r in misses.collect()} == {"lost": "UNRESOLVED", "5.3": "UNRESOLVED", "x/Timer/t": "case-only"}
    summary = {r.rule: r.findings for r in validation.dangling_summary(found, misses).collect()}
    assert summary == {"pseudo-type-target": 1, "case-only": 1, "UNRESOLVED": 1}


def test_near_miss_rules_in_order(spark):
    ids = spark.createDataFrame([(0, "n/timer/T-300"), (1, "n/clause/5-3-3"), (2, "n/message/Setup")], "ord int, id string")
    refs = ["n/TIMER/t-300", "n/timer/T_300", "n/clause/Clause-5-3-3", "n/ie/Setup", "n/ie/zzz"]
    got = {r.ref: (r.rule, r.target) for r in validation.near_misses(spark.createDataFrame([(r,) for r in refs], "ref string"), ids, ["clause", "timer"]).collect()}
    assert [got[r][0] for r in refs] == ["case-only", "separator", "type-word-prefix", "wrong-type-bucket", "UNRESOLVED"] and got[refs[4]][1] is None


def test_ranges_are_pinned(spark):
    allowed = {(r.rel, r.slot, r.type) for r in Ontology().allowed(spark).collect()}
    for rel in ("READS", "WRITES"):
        assert all((rel, "dst", t) in allowed for t in ("UEVariable", "InformationElement", "SIPHeader", "Identity"))
        assert not any((rel, "dst", t) in allowed for t in ("Timer", "Procedure", "Message", "State"))
    assert Ontology().pseudo_types() == {"Clause"}
    pseudo = {r.rel: (r.pseudo_src, r.pseudo_dst) for r in Ontology().relations(spark).collect()}
    assert pseudo["DEFINED_IN"] == (False, True) and pseudo["STARTS"] == (False, False)


def test_retyping_is_stable(spark):
    entities = spark.createDataFrame([entity(0, "p", "Procedure"), entity(1, "e", "Event")], ENTITIES)
    relations = spark.createDataFrame([relation(0, "a", "TRIGGERS", "p", "e"), relation(1, "b", "TRIGGERS", "e", "p")], RELATIONS)
    rules = spark.createDataFrame([("TRIGGERS", "Procedure", "Event", "RAISES")], "type string, src_type string, dst_type string, new_type string")
    assert [r.id for r in validation.retype_plan(entities, relations, rules).collect()] == ["a"]
    after = validation.retyped(entities, relations, rules)
    assert {r.id: r.type for r in after.collect()} == {"a": "RAISES", "b": "TRIGGERS"}
    assert validation.retype_plan(entities, after, rules).count() == 0


def test_conflicts_and_review(spark):
    relations = spark.createDataFrame([relation(0, "a", "GOVERNS", "t", "p1", clause="c", anchor="x"), relation(1, "b", "GOVERNS", "t", "p2"), relation(2, "c", "EXCHANGES", "p", "m1"), relation(3, "d", "EXCHANGES", "p", "m2", confidence="low")], RELATIONS)
    groups = review.conflict_groups(relations).collect()
    assert [(g.src, [m.dst for m in g.members], g.members[0].clause) for g in groups] == [("t", ["p1", "p2"], "c")]
    entities = spark.createDataFrame([entity(0, "e", "Timer", confidence="med")], ENTITIES)
    warned = spark.createDataFrame([(0, "entity", "e", 0, "9", "q", "clause-missing")], "row_ord long, what string, id string, pos int, clause string, anchor string, cat string")
    assert [r.kind for r in review.review_queue(entities, relations, warned).orderBy("section", "pos").collect()] == ["conflict-group", "ambiguous-entity-type", "low-confidence-relation", "validation-warning"]


def test_warnings(spark, clauses):
    entities = spark.createDataFrame([entity(0, "a", "Timer", clause="5.3.3.2", anchor="starts timer T300 and"), entity(1, "b", "Timer", clause="5.3.3.2", anchor="never said here at all"), entity(2, "c", "Timer", clause="9.9", anchor="x"), entity(3, "d", "Timer", clause="5.3.3", anchor="Initiation")], ENTITIES)
    none = spark.createDataFrame([], RELATIONS)
    got = validation.warnings(entities, none, corpus.haystacks(clauses), "19.2.0")
    assert {(r.id, r.cat) for r in got.collect()} == {("b", "anchor-missing"), ("c", "clause-missing")}
    assert validation.warnings(entities, none, corpus.haystacks(clauses), "18.0.0").count() == 0


def test_aliases(spark):
    rows = [entity(0, "c1", "Message", "RRCReconfiguration", "deterministic:vocab"), entity(1, "c2", "Timer", "T300", "deterministic:vocab"), entity(2, "s1", "Message", "RRC reconfiguration message", "llm"), entity(3, "s2", "Timer", "timer T300", "llm"), entity(4, "s3", "State", "new state", "llm"), entity(5, "s4", "Message", "Unrelated", "llm"), entity(6, "c3", "SIPMethod", "REGISTER", "deterministic:vocab"), entity(7, "s5", "Message", "REGISTER request", "llm")]
    entities = spark.createDataFrame(rows, ENTITIES)
    got = {r.surface_id: r for r in review.suggest_aliases(entities, Ontology().compatible(spark), 0.35).collect()}
    assert set(got) == {"s1", "s2", "s4", "s5"} and got["s2"].distance == 0.25
    assert {s for s, r in got.items() if r.proposal == "merge"} == {"s1", "s2", "s5"} and got["s5"].canonical_id == "c3"
    vectors = spark.createDataFrame([(r[3], [1.0, 0.0] if "t300" in r[3].lower() else [0.0, 1.0]) for r in rows], "label string, vector array<double>")
    by_vector = {r.surface_id: r.distance for r in review.suggest_aliases(entities, Ontology().compatible(spark), 0.35, vectors).collect()}
    assert by_vector["s2"] == 0.0
    assert review.suggest_aliases(entities.where("extractor <> 'llm'"), Ontology().compatible(spark), 0.35).count() == 0


def test_histogram_and_boundary(spark):
    rows = [(i, str(i), d) for i, d in enumerate([0.01, 0.02, 0.30, 0.34, 0.36, 0.40, 0.72, 1.5])]
    s = spark.createDataFrame(rows, "surface_ord long, surface_id string, distance double")
    got = review.distance_histogram(s).orderBy("lo").collect()
    assert sum(r.n for r in got) == 7 and got[-1].cumulative == 7 and {r.lo: r.n for r in got}[0.3] == 2
    assert sum(r.n for r in review.distance_histogram(s, overflow=True).collect()) == 8
    near = {(r.side, r.place): r.surface_id for r in review.boundary(s, 0.35, 2).collect()}
    assert near == {("below", 1): "3", ("below", 2): "2", ("above", 1): "4", ("above", 2): "5"}


def test_runs_against_runs(spark):
    a = spark.createDataFrame([("s", "T", "x"), ("s", "T", "y"), ("q", "T", "x")], "src string, type string, dst string")
    b = spark.createDataFrame([("s", "T", "x"), ("s", "T", "z"), ("r", "T", "x")], "src string, type string, dst string")
    assert [(r.src, r.both, r.only_a, r.only_b) for r in comparison.object_divergence(a, b).collect()] == [("s", ["x"], ["y"], ["z"])]
    ids = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2"), ("c", "9")], "label string, id string")
    got = {(r.label_a, r.label_b): (r.both, r.only_a, r.only_b, r.jaccard) for r in comparison.set_compare(ids).collect()}
    assert got == {("a", "b"): (1, 1, 0, 0.5), ("a", "c"): (0, 2, 1, 0.0), ("b", "c"): (0, 1, 1, 0.0)}


def test_evaluation_counts_aliases_for_precision_only(spark):
    gold_e = spark.createDataFrame([entity(0, "g1", "Timer", "T 300"), entity(1, "g2", "Procedure", "Setup")], ENTITIES)
    gold_r = spark.createDataFrame([relation(0, "r", "GOVERNS", "g1", "g2")], RELATIONS)
    run_e = spark.createDataFrame([entity(0, "p1", "Timer", "t-300"), entity(1, "p2", "Procedure", "setup"), entity(2, "p3", "Procedure", "the setup", "llm"), entity(3, "p4", "State", "idle")], ENTITIES)
    run_r = spark.createDataFrame([relation(0, "a", "GOVERNS", "p1", "p3", extractor="llm"), relation(1, "b", "GOVERNS", "p1", "p4", extractor="llm")], RELATIONS)
    aliases = spark.createDataFrame([("p3", "p2")], "surface string, canonical string")
    got = {(r.part, r.measure): (r.matched, r.total) for r in comparison.evaluate(gold_e, gold_r, run_e, run_r, aliases).where("type is null").collect()}
    assert got == {("entities", "recall"): (2, 2), ("entities", "precision"): (3, 4), ("relations", "recall"): (1, 1), ("relations", "precision"): (1, 2), ("model relations", "supported"): (1, 2)}
    itself = comparison.evaluate(gold_e, gold_r, gold_e, gold_r, aliases.limit(0)).collect()
    assert all(r.matched == r.total for r in itself)


def test_evaluation_broadcasts_nothing(spark):
    gold_e, gold_r = spark.createDataFrame([(0, "g1", "Part", "a")], "ord long, id string, type string, label string"), spark.createDataFrame([("MADE", "g1", "g1", "llm")], "type string, src string, dst string, extractor string")
    aliases = spark.createDataFrame([("x1", "g1")], "surface string, canonical string")
    plans = [comparison.evaluate(gold_e, gold_r, gold_e, gold_r, aliases, resolve)._jdf.queryExecution().executedPlan().toString() for resolve in (False, True)]
    assert all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)


def test_closures_end_in_cycles(spark):
    links = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("z", "z")], "node string, parent string")
    got = {(r.node, r.ancestor, r.depth) for r in graphs.ancestors(links).collect()}
    assert got == {("a", "a", 0), ("b", "b", 0), ("b", "a", 1), ("c", "c", 0), ("c", "b", 1), ("c", "a", 2), ("x", "x", 0), ("x", "y", 1), ("y", "y", 0), ("y", "x", 1), ("z", "z", 0)}
    assert {r.node: r.depth for r in graphs.depths(links).collect()}["c"] == 2


def test_highlights_skip_overlaps(spark):
    clauses = spark.createDataFrame([("k", "the UE starts T300 now")], "key string, text string")
    facts = spark.createDataFrame([("k", 0, "starts T300"), ("k", 1, "T300 now"), ("k", 2, "the UE"), ("k", 3, "absent")], "key string, pos int, anchor string")
    assert sorted((r.start, r.pos) for r in graphs.highlights(facts, clauses).collect()) == [(1, 2), (8, 0)]


def test_views(spark, clauses):
    result = run.build(clauses, CFG)
    nodes, edges = graphs.view_nodes(result.entities, clauses, "Rel-19"), graphs.view_edges(result.entities, result.relations, clauses, "Rel-19")
    assert {r.grp for r in nodes.collect()} == {"Procedure", "Timer", "Message", "Clause"}
    ids = {r.id for r in nodes.collect()}
    assert all(r.src in ids and r.dst in ids for r in edges.collect())


def test_renames_against_brute_force(spark):
    """Candidates through rare neighbours lose no pair, whatever the bar; all keys share one neighbour."""
    rng = random.Random(11)
    links = [(f"{side}{i}", n) for side in "gn" for i in range(25) for n in {"hub", *(f"x{rng.randint(0, 12)}" for _ in range(rng.randint(0, 6)))}]
    seen = spark.createDataFrame([(k, 1 if k[0] == "g" else 2) for k in {k for k, _ in links}], "key string, release long")
    rows = spark.createDataFrame(links + links[:9], "key string, neighbour string")
    sets = {}
    for k, n in links:
        sets.setdefault(k, set()).add(n)
    share = {(g, n): round(len(sets[g] & sets[n]) / len(sets[g] | sets[n]), 4) for g in sets if g[0] == "g" for n in sets if n[0] == "n"}
    for least in (0.1, 0.3333, 0.5, 0.75, 1.0):
        got = {(r.gone, r.new): r.overlap for r in history.renames(seen, rows, 2, least).collect()}
        assert got == {p: o for p, o in share.items() if o >= least and o > 0}


def test_history(spark):
    values = spark.createDataFrame([("k", i, v) for i, v in enumerate(["A", "A", "B", "A", None, None])], "key string, at long, value string")
    got = history.segments(values).orderBy("segment").collect()
    assert [(r.value, r.valid_from, r.valid_to, r.supersedes) for r in got] == [("A", 0, 2, None), ("B", 2, 3, 1), ("A", 3, 4, 2), (None, 4, None, 3)]
    assert [r.value for r in history.as_of(history.segments(values), 2).collect()] == ["B"]
    seen = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), ("c", 3)], "key string, release long")
    got = {r.key: (r.introduced, r.floor, r.valid_until, r.gaps) for r in history.presence(seen, 1, 3).collect()}
    assert got == {"a": (1, True, None, 1), "b": (2, False, 2, 0), "c": (3, False, None, 0)}
    links = spark.createDataFrame([("b", "n1"), ("b", "n2"), ("c", "n1"), ("c", "n2"), ("c", "n3")], "key string, neighbour string")
    assert [(r.gone, r.new, r.overlap) for r in history.renames(seen, links, 3).collect()] == [("b", "c", 0.6667)]
    kinds = [("a", "T", "L", "x"), ("b", "T", "L", "setup timer"), ("c", "T", "L", "setup timers"), ("c2", "T", "M", "setup timer"), ("c3", "U", "L", None), ("b2", "U", "L", "y"), ("b2", "U", "L", "y")]
    about = spark.createDataFrame(kinds, "key string, type string, layer string, label string")
    more = seen.union(spark.createDataFrame([("c2", 3), ("c3", 3), ("b2", 2)], seen.schema))
    near = links.union(spark.createDataFrame([(k, n) for k in ("c2", "c3", "b2") for n in ("n1", "n2", None)], links.schema))
    got = {(r.gone, r.new): (r.shared, r.overlap, r.similarity) for r in history.renames(more, near, 3, 0.5, about).collect()}
    assert got == {("b", "c"): (2, 0.6667, 0.9565), ("b2", "c3"): (2, 1.0, None)}
    versions = spark.createDataFrame([("R", "19.2.0"), ("R", "19.10.0")], "release string, version string")
    assert history.representative(versions).first().version == "19.10.0"


def test_derive_does_not_depend_on_order(spark):
    rows = [("Rel-18", *entity(0, "a", "Timer", "old", clause="c1", anchor="x")), ("Rel-19", *entity(0, "a", "Timer", "new", clause="c2", anchor="x")), ("Rel-18", *entity(1, "b", "Timer", "gone"))]
    for order in (rows, rows[::-1]):
        got = {r.id: r for r in history.derive(spark.createDataFrame(order, "release string, " + ENTITIES), "defined_in", ("Rel-18", "Rel-19")).collect()}
        assert got["a"].label == "new" and got["a"].observed_in == ["Rel-18", "Rel-19"] and got["a"].introduced_in == "Rel-18" and len(got["a"].defined_in) == 2
        assert got["b"].valid_until == "Rel-18" and got["a"].valid_until is None


def test_configuration(spark):
    assert Registry(CFG).get("TS 38.331", "20.1.0").release == "Rel-20" and CFG.store_name == "38331-19.2.0"
    with pytest.raises(KeyError, match="TS 38.331"):
        Registry(CFG).get("other", "1")
    spark.conf.set("clausework.rho", "0.3")
    spark.conf.set("clausework.retries", "many")
    assert Options.of(spark).rho == 0.3 and Options.of(spark, rho=0.1).rho == 0.1 and Options.of(spark).retries == 3
    spark.conf.unset("clausework.rho")
    spark.conf.unset("clausework.retries")


def test_later_headings_can_win(spark):
    rows = [("d", 0, "p", "Heading 1", 1, "5\tTop"), ("d", 1, "p", "Normal", None, "first"), ("d", 2, "p", "Heading 1", 1, "5\tAgain"), ("d", 3, "p", "Normal", None, "second"), ("d", 4, "p", "Heading 1", 1, "Loose")]
    got = {r.key: (r.title, r.text) for r in corpus.fold_clauses(spark.createDataFrame(rows, BLOCKS), last_wins=True, base="?").collect()}
    assert got == {"5": ("Again", "second"), "5/Loose": ("Loose", "")}


def test_curated_graph_is_sound_and_strict_types_can_be_asked_for(spark):
    from clausework.operators import curated

    items = spark.createDataFrame([(0, "t", "Timer", "T300", "7.1"), (1, "p", "Procedure", "Setup", "5.3"), (2, "m", "SIPMethod", "INVITE", None)], "ord long, key string, type string, label string, clause string")
    concepts = spark.createDataFrame([(0, "C_ROOT", "DomainRoot", "Root", None), (1, "C_RRC", "ProtocolLayer", "RRC", "C_S"), (2, "C_S", "Stratum", "AS", "C_ROOT")], "ord long, key string, type string, label string, broader string")
    facts = spark.createDataFrame([(0, "t", "p", "GOVERNS", "prose", "high", "5.3", None, "role: guard", "q"), (1, "p", "m", "EXCHANGES", "prose", "high", None, "p", "", None)], "ord long, src string, dst string, type string, modality string, confidence string, clause string, procedure string, attrs string, quote string")
    entities, relations = curated.curated_graph(items, concepts, facts, ("Rel-15", "Rel-16"), "C_RRC", CFG)
    assert entities.count() == 8 and {r.type: r.n for r in relations.groupBy("type").agg(F.count(F.lit(1)).alias("n")).collect()} == {"GOVERNS": 1, "EXCHANGES": 1, "IN_LAYER": 2, "BROADER": 2, "NEXT_RELEASE": 1}
    assert validation.findings(entities, relations).count() == 0
    assert [r.cat for r in validation.findings(entities, relations, subtypes=False).collect()] == ["range-violation"]
    assert [r.attrs for r in relations.where("type = 'GOVERNS'").collect()] == [{"role": "guard"}]


def test_audit(spark):
    from clausework.operators import audit

    entities, relations = faulty(spark)
    found = validation.findings(entities, relations)
    warned = spark.createDataFrame([], "row_ord long, what string, id string, pos int, clause string, anchor string, cat string")
    presence = history.presence(spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "key string, release long"), 1, 2)
    segments = history.segments(spark.createDataFrame([("k", i, v) for i, v in enumerate("AABA")], "key string, at long, value string"))
    marked = spark.createDataFrame([], "key string")
    got = {r.risk: (r.hits, r.passed) for r in audit.audit(entities, relations, found, warned, presence, segments, marked).collect()}
    assert got == {"R1": (11, False), "R2": (0, True), "R3": (1, False), "R4": (1, True), "R5": (6, True), "R6": (2, True), "R7": (0, True)}


def test_alias_lexical_meets_all_parts(spark):
    from clausework.functions.kernels import label_distance
    from clausework.plans import adapters, catalogue

    d = "/root/testdata/sf0.001"
    parts = [(r.p_partkey, r.p_name, r.p_brand) for r in adapters.table(spark, d, "part").collect()]
    got = {r.surface_id: (r.canonical_id, r.distance) for r in catalogue.q_alias_lexical(spark, d).collect()}
    canonical = [p for p in parts if p[0] % 2 == 0]
    want = {str(k) for k, _, brand in parts if k % 2 and any(c[2] == brand for c in canonical)}
    assert set(got) == want and len(want) > len(parts) // 4
    for k, name, brand in parts:
        if str(k) in want:
            best = min((label_distance(name, c[1]), c[0]) for c in canonical if c[2] == brand)
            assert got[str(k)] == (str(best[1]), pytest.approx(best[0], abs=1e-4))


def test_ancestors_of_a_chain_beyond_64_levels(spark):
    links = spark.createDataFrame([(i, i - 1 if i else None) for i in range(70)], "node long, parent long")
    got = graphs.ancestors(links).where("node = 69").collect()
    assert sorted((r.ancestor, r.depth) for r in got) == [(69 - d, d) for d in range(69, -1, -1)]
