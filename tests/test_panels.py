"""Concept trees, facts marked in their clauses, and the pages that show them."""

import pytest
from pyspark.sql import functions as F

from clausework.functions import text as X
from clausework.operators import graphs, panels
from clausework.plans import reports
from clausework.schema import SpecConfig
from clausework.sources import exports, stores

CONCEPT = "ord long, id string, type string, label string, broader string"


@pytest.fixture(scope="module")
def tree_rows(spark):
    concepts = spark.createDataFrame([(0, "root", "DomainRoot", "All", None), (2, "b", "Stratum", "B<", "root"), (1, "a", "Stratum", "A", "root"), (3, "c", "ProtocolLayer", None, "a"), (4, "x", "Stratum", "X", "y"), (5, "y", "Stratum", "Y", "x"), (6, "o", "Stratum", "O", "gone")], CONCEPT)
    entities = spark.createDataFrame([("e0", "first"), ("e1", None)], "id string, label string")
    relations = spark.createDataFrame([(3, "IN_LAYER", "e0", "c"), (2, "IN_LAYER", "e1", "c"), (1, "IN_LAYER", "lost", "c"), (9, "IN_LAYER", "e0", "c"), (4, "IN_LAYER", "e0", "nowhere"), (5, "GOVERNS", "e0", "c")], "ord long, type string, src string, dst string")
    return concepts, entities, relations


def test_a_concept_tree_has_chains_children_and_members(tree_rows):
    got = {r.id: r for r in panels.concept_tree(*tree_rows).collect()}
    assert got["c"].chain == ["c", "A", "All"] and got["c"].depth == 2 and got["root"].chain == ["All"]
    assert got["root"].narrower == ["A", "B<"] and got["root"].n_narrower == 2 and got["c"].narrower == []
    assert got["c"].members == ["lost", "e1", "first"] and got["c"].n == 3 and got["a"].n == 0 and got["a"].members == []
    assert got["o"].chain == ["O", "gone"] and got["x"].chain == ["X", "Y"] and all(r.in_scope for r in got.values())
    few = {r.id: r for r in panels.concept_tree(*tree_rows, shown=1).collect()}
    assert few["c"].members == ["lost"] and few["c"].n == 3 and few["root"].narrower == ["A"] and few["root"].n_narrower == 2


def test_a_concept_page_nests_and_says_what_is_not_shown(tree_rows):
    concepts, entities, relations = tree_rows
    page = exports.concept_page(panels.concept_tree(concepts.withColumn("in_scope", F.col("id") != "b"), entities, relations, shown=1), "t")
    assert page.index("id='root'") < page.index("id='a'") < page.index("id='c'") < page.index("id='b'") and "and 2 more" in page
    assert "<li id='b' class='aside'><b>B&lt;</b>" in page and page.count("<li id=") == 7 and page.count("<ul>") == page.count("</ul>") == 8
    with pytest.raises(ValueError, match="more than 2 concepts"):
        exports.concept_page(panels.concept_tree(*tree_rows), "t", most=2)


def test_no_concepts(spark, tree_rows):
    none = spark.createDataFrame([], CONCEPT)
    assert panels.concept_tree(none, *tree_rows[1:]).count() == 0


@pytest.mark.parametrize(
    ("anchor", "span"),
    [("starts T300", (8, 11)), (" .:starts T300;, ", (8, 11)), ("then it starts T300 now", (8, 15)), ("it starts T300 now", (8, 15)), ("starts T300 then", None), ("no T300 now", None), ("", None), (" . ", None), (None, None), ("now" * 20, None)],
)
def test_anchors_are_located_by_their_endings(spark, anchor, span):
    row = spark.createDataFrame([(anchor, "the UE starts T300 now")], "anchor string, text string").select(X.located(F.col("anchor"), F.col("text")).alias("at")).first()
    assert (row["at"] and tuple(row["at"])) == span


def test_anchors_are_located_by_their_first_characters(spark):
    text = "é" + "a b" * 20
    row = spark.createDataFrame([(text[:45] + "!", text)], "anchor string, text string").select(X.located(F.col("anchor"), F.col("text")).alias("at")).first()
    assert tuple(row["at"]) == (1, 40)


PROV = "provenance array<struct<release:string,spec:string,version:string,clause:string,anchor:string,curated:boolean,external:boolean>>"


@pytest.fixture(scope="module")
def fact_rows(spark):
    clauses = spark.createDataFrame([("k", "T", "the UE <starts> T300 now"), ("m", None, None), ("n", "no facts", "text")], "key string, title string, text string")
    entities = spark.createDataFrame([("a", "UE"), ("b", "T300")], "id string, label string")
    at = lambda clause, anchor: [("Rel-19", "TS", "1", clause, anchor, None, None)]
    rows = [(0, at("k", "<starts> T300")), (1, at("k", "T300 now")), (2, at("k", "the UE")), (3, at("k", "absent")), (4, at("m", "x")), (5, at(None, "x")), (6, []), (7, at("k", "the UE <starts>"))]
    relations = spark.createDataFrame([(o, f"r{o}", "STARTS", "a", "b" if o else "gone", "prose", "high", p) for o, p in rows], f"ord long, id string, type string, src string, dst string, modality string, confidence string, {PROV}")
    return clauses, entities, relations


def test_facts_of_clauses_and_their_marks(spark, fact_rows):
    facts = panels.clause_facts(*fact_rows, "Rel-19")
    got = {r.pos: (r.key, r.src_label, r.dst_label, r.start, r.length) for r in facts.collect()}
    assert got == {0: ("k", "UE", "gone", 8, 13), 1: ("k", "UE", "T300", None, None), 2: ("k", "UE", "T300", 1, 6), 3: ("k", "UE", "T300", None, None), 4: ("m", "UE", "T300", None, None), 7: ("k", "UE", "T300", None, None)}
    marked = {r.key: [tuple(p) for p in r.parts] for r in panels.marked_texts(fact_rows[0], facts).collect()}
    assert marked == {"k": [("the UE", 2), (" ", None), ("<starts> T300", 0), (" now", None)], "m": []}
    page = exports.facts_page(panels.marked_texts(fact_rows[0], facts), facts, "t")
    assert "<mark id='k:0'>&lt;starts&gt; T300</mark>" in page and "<a href='#k:2'>" in page and "<a href='#k:1'>" not in page and page.count("<li>") == 6
    with pytest.raises(ValueError, match="more than 1 clauses"):
        exports.facts_page(panels.marked_texts(fact_rows[0], facts), facts, "t", most=1)
    assert panels.clause_facts(*(x.limit(0) for x in fact_rows), "Rel-19").count() == 0


def test_many_facts_at_one_place_keep_the_first(spark):
    clauses = spark.createDataFrame([("k", "one two three")], "key string, text string")
    facts = spark.range(5000).select(F.lit("k").alias("key"), F.col("id").alias("pos"), F.lit("two").alias("anchor"))
    assert [tuple(r) for r in graphs.highlights(facts, clauses).select("pos", "start", "length").collect()] == [(0, 5, 3)]


def test_pages_of_a_run_by_the_command_line(spark, tmp_path, capsys):
    cfg = SpecConfig("TS 38.331", "19.2.0")
    at = ["--snapshots", str(tmp_path / "runs"), "--spec", cfg.spec, "--version", cfg.version, "--label", "r"]
    clauses = spark.createDataFrame([("38331-19.2.0", 0, "5.1", "5.1", "Setup", 1, None, "The UE starts T300.", 0, cfg.spec, cfg.version)], "doc_id string, ord int, key string, number string, title string, level int, parent string, text string, tables int, spec string, version string")
    stores.write_store(clauses, str(tmp_path / "store"))
    life = ([], None, None, None)
    entity = lambda o, i, kind, label: (o, i, kind, label, "x", None, None, [("Rel-19", cfg.spec, cfg.version, "5.1", label, None, None)], *life)
    relation = lambda o, kind, src, dst, anchor: (o, f"r{o}", kind, src, dst, "prose", "high", None, {}, "x", [("Rel-19", cfg.spec, cfg.version, "5.1" if anchor else None, anchor, None, None)], *life)
    from clausework.schema import ENTITIES, RELATIONS

    entities = spark.createDataFrame([entity(0, "ue", "Entity", "UE"), entity(1, "t", "Timer", "T300"), entity(2, "root", "DomainRoot", "All"), entity(3, "rrc", "ProtocolLayer", "Control")], ENTITIES)
    relations = spark.createDataFrame([relation(0, "STARTS", "ue", "t", "starts T300"), relation(1, "BROADER", "rrc", "root", None), relation(2, "IN_LAYER", "t", "rrc", None)], RELATIONS)
    stores.Snapshots(spark, str(tmp_path / "runs")).commit({"entities": entities, "relations": relations}, cfg, "r")
    store = ["--store", str(tmp_path / "store")]
    for name, more in (("concepts", []), ("facts", store), ("view", store), ("view", [*store, "--types", "IN_LAYER"]), ("view", [*store, "--since", "r"])):
        reports.main([name, *at, *more, "--out", str(tmp_path / "page.html")])
        page = (tmp_path / "page.html").read_text()
        expected = {"concepts": "<b>Control</b> (1)", "facts": "<mark id='5.1:0'>starts T300</mark>", "view": "DEFINED_IN" if "--types" not in more else "IN_LAYER"}[name]
        assert expected in page and ("STARTS" in page) == (name == "facts" or (name == "view" and more == store))
    with pytest.raises(SystemExit):
        reports.main(["view", *at])
    assert "--store" in capsys.readouterr().err
