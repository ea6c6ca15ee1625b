"""Command lines that build stores and layers."""

import json

import pytest
from pyspark.sql import functions as F

from clausework.operators import curated
from clausework.plans import builds
from clausework.sources import stores
from tests.test_tables import docx

AT = ["--spec", "TS 38.331", "--version", "19.2.0"]


def test_a_store_of_a_word_file_can_be_run(spark, tmp_path, capsys):
    docx(tmp_path / "in" / "spec.docx", ("h1", "5.1\tSetup"), ("x", "starts T300"), ("h1", "General"), ("x", "more"))
    builds.main(["store", *AT, "--word", str(tmp_path / "in"), "--out", str(tmp_path / "store")])
    rows = stores.read_store(spark, str(tmp_path / "store")).orderBy("ord").collect()
    assert "clauses" in capsys.readouterr().out and {(r.spec, r.version, r.doc_id) for r in rows} == {("TS 38.331", "19.2.0", "38331-19.2.0")}
    assert rows and all(r.key for r in rows) and any("starts T300" in (r.text or "") for r in rows)
    docx(tmp_path / "in" / "other.docx", ("h1", "5.2\tOther"))
    with pytest.raises(ValueError, match="more than one"):
        builds.main(["store", *AT, "--word", str(tmp_path / "in"), "--out", str(tmp_path / "no")])


def test_layers_are_committed_as_a_run(spark, tmp_path, capsys):
    parts = {
        "items": [{"ord": 0, "key": "t", "type": "Timer", "label": "T300", "clause": "5.1"}, {"ord": 1, "key": "p", "type": "Procedure", "label": "Setup", "clause": None}],
        "concepts": [{"ord": 0, "key": "root", "type": "DomainRoot", "label": "All", "broader": None}, {"ord": 1, "key": "as", "type": "Stratum", "label": "Access", "broader": "root"}, {"ord": 2, "key": "rrc", "type": "ProtocolLayer", "label": "Control", "broader": "as"}],
        "facts": [{"ord": 0, "src": "p", "dst": "t", "type": "STARTS", "clause": "5.1", "quote": "starts T300"}],
    }
    for name, rows in parts.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    files = [x for name in parts for x in (f"--{name}", str(tmp_path / f"{name}.json"))]
    builds.main(["layers", *AT, *files, "--layer", "rrc", "--snapshots", str(tmp_path / "runs")])
    shown = capsys.readouterr().out
    runs = stores.Snapshots(spark, str(tmp_path / "runs"))
    assert "Control" in shown and {r.type for r in runs.read("relations", label="gold").collect()} == {"STARTS", "IN_LAYER", "BROADER", "NEXT_RELEASE"}
    lines = [[c.strip() for c in line.split("|")[2:5]] for line in shown.splitlines() if line.startswith("|") and "depth" not in line]
    assert sorted(lines) == [["Access", "1", "0"], ["All", "0", "0"], ["Control", "2", "1"]]
    with pytest.raises(SystemExit):
        builds.main(["layers", *AT])


def test_an_order_that_does_not_fit_is_an_error(spark):
    at = lambda v, kind: spark.range(1).select(curated._behind(F.lit(v), kind).alias("o")).first().o
    assert at(5, 0) < at((1 << 40) - 1, 0) < at(0, 1)
    for wrong in (1 << 40, -1):
        with pytest.raises(Exception, match="no order"):
            at(wrong, 1)
