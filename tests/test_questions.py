"""The questions over a small hand-made graph, with ends that name nothing and empty graphs."""

import pytest

from clausework.operators import questions as Q

ENTITIES = "id string, type string, label string, defined_in array<struct<spec: string, release: string, clause: string>>"
RELATIONS = "ord long, type string, src string, dst string, attrs map<string,string>"


@pytest.fixture(scope="module")
def graph(spark):
    at = lambda c: [("S", "Rel-19", c)]
    entities = [
        ("p1", "Procedure", "setup", at("1.1") + at("1.1")), ("p2", "Procedure", "resume", at("1.2")), ("m1", "Message", "Request", at("2")), ("m2", "Message", "Reject", None),
        ("t1", "Timer", "T1", []), ("s1", "State", "idle", at("3")), ("s2", "State", "on", at("3")), ("c1", "Condition", "barred", at("3")), ("e1", "Event", "T1 expiry", at("4")), ("i1", "InformationElement", "cause", at("5")),
    ]
    relations = [
        (1, "EXCHANGES", "p1", "m1", {"direction": "up"}), (2, "EXCHANGES", "p1", "m2", None), (3, "EXCHANGES", "p2", "gone", {}), (4, "REUSED_BY", "m1", "p2", {}), (5, "REUSED_BY", "m1", "p1", {}),
        (6, "STARTS", "p1", "t1", {}), (7, "GOVERNS", "t1", "p2", {}), (8, "ON_EXPIRY_OF", "e1", "t1", {}), (9, "ON_EXPIRY_OF", "e0", "t1", {}),
        (10, "HAS_PRECONDITION", "p1", "c1", {}), (11, "HAS_PRECONDITION", "p1", "s1", {}), (12, "TRANSITIONS_TO", "p1", "s1", {}), (13, "TRANSITIONS_TO", "p1", "s2", {}), (14, "TRANSITIONS_TO", "p2", "s1", {}),
        (15, "CONTAINS", "m1", "i1", {"optional": "True"}), (16, "CONTAINS", "m1", "i2", {"optional": "no"}), (17, "CONTAINS", "m2", "i1", None),
        (18, "INVOKES", "p1", "p2", {}), (19, "ON_FAILURE_INVOKES", "p1", "p3", {}), (20, "TRIGGERS", "e1", "p1", {}),
    ]
    return spark.createDataFrame(entities, ENTITIES), spark.createDataFrame(relations, RELATIONS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_answers(graph):
    e, r = graph
    assert rows(Q.messages(e, r)) == [("p1", "m1", "Request", "up"), ("p1", "m2", "Reject", None), ("p2", "gone", None, None)]
    assert rows(Q.timers(e, r)) == [("p1", "t1", "T1", "starts", "e1"), ("p2", "t1", "T1", "governs", "e1")]
    assert rows(Q.states(e, r)) == [("p1", "idle", "on"), ("p2", None, "idle")]
    assert rows(Q.elements(e, r)) == [("m1", "i1", "cause", True), ("m1", "i2", None, False), ("m2", "i1", "cause", False)]
    assert rows(Q.invoked(e, r)) == [("p1", "setup", "p2", False), ("p1", "setup", "p3", True), ("p2", "resume", None, None)]
    assert rows(Q.reuse(r)) == [("m1", 2)]
    assert rows(Q.triggers(e, r)) == [("p1", "setup", "precondition", "c1", "barred"), ("p1", "setup", "precondition", "s1", "idle"), ("p1", "setup", "trigger", "e1", "T1 expiry")]
    assert rows(Q.definitions(e.where("id in ('p1', 'm2', 't1')"))) == [("p1", "S", "Rel-19", "1.1")]


def test_empty(graph):
    e, r = (x.limit(0) for x in graph)
    for df in (Q.messages(e, r), Q.timers(e, r), Q.states(e, r), Q.elements(e, r), Q.invoked(e, r), Q.reuse(r), Q.triggers(e, r), Q.definitions(e)):
        assert df.collect() == []


def test_relations_are_not_dealt_by_their_state(graph, spark):
    """Three states may end all relations: dealt by state, they would go to three tasks."""
    e, r = graph
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Q.states(e, r)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(src" in plan and "hashpartitioning(dst" not in plan
