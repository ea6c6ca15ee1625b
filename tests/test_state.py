"""Streams merged in state against the merge of all records at once."""

import json
import random

from pyspark.sql import functions as F

from clausework.operators import merging
from clausework.schema import ENTITIES
from clausework.session import ship
from clausework.streaming import ingest, state

FIELDS = [c.split(" ", 1)[0] for c in ENTITIES.split(", ")]


def some(seed, batches, ids=12):
    """(batch, ord, id, label, provenance): records of few ids, orders not ascending, clauses that repeat and lack."""
    r = random.Random(seed)
    item = lambda: {"release": "Rel-19", "spec": None, "version": "1", "clause": r.choice(["5.1", "5.2", None]), "anchor": r.choice(["a", "b", None]), "curated": None, "external": None}
    return [(b, r.randrange(1000) * 100 + i, f"e{r.randrange(ids)}", f"label {b} {i}", [item() for _ in range(r.randrange(4))]) for b in range(batches) for i in range(r.randrange(1, 6))]


def plain(rows):
    out = {}
    for b, o, i, label, items in sorted(rows, key=lambda x: x[:2]):
        record = out.setdefault(i, (label, [], set()))
        new = [p for p in items if (p["clause"], p["anchor"]) not in record[2]]
        record[1].extend(new)
        record[2].update((p["clause"], p["anchor"]) for p in new)
    return {i: (label, items) for i, (label, items, _) in out.items()}


def test_two_hundred_batches_in_any_order():
    rows = some(1, 200)
    for seed in range(3):
        late = rows[:]
        random.Random(seed).shuffle(late)
        ids: dict = {}
        for b, o, i, label, items in late:
            known = ids.setdefault(i, state.Known())
            known.items.update(known.add((b, o), label, items, known.items.get))
        assert {i: (k.first[1], state.in_order(list(k.items.values()))) for i, k in ids.items()} == plain(rows)


def frame(spark, rows):
    df = spark.createDataFrame([(b, o, i, label, json.dumps(p)) for b, o, i, label, p in rows], "batch long, ord long, id string, label string, p string")
    df = df.withColumn("defined_in", F.from_json("p", spark.createDataFrame([], ENTITIES).schema["defined_in"].dataType)).drop("p")
    for c in ENTITIES.split(", "):
        name, kind = c.split(" ", 1)
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df.select("batch", *FIELDS)


def test_a_stream_with_late_rows_and_a_restart_equals_the_batch_merge(spark, tmp_path):
    ship(spark)
    rows = some(2, 6)
    source, out, cp = (str(tmp_path / x) for x in ("entities", "out", "checkpoint"))
    arrived = [2, 0, 1, 5, 3, 4]

    def arrive(batches):
        frame(spark, [r for r in rows if r[0] in batches]).coalesce(1).write.mode("append").partitionBy("batch").parquet(source)
        state.merge_stream(spark, source, out, cp, "defined_in", keep_ms=3_600_000, files=2).awaitTermination()

    def show(df):
        return {r.id: (r.label, [p.asDict() for p in r.defined_in]) for r in df.collect()}

    arrive(arrived[:3])
    assert show(state.latest(spark, out)) == plain([r for r in rows if r[0] in arrived[:3]])
    arrive(arrived[3:])  # another query, from the same checkpoint
    got = show(state.latest(spark, out))
    assert got == plain(rows)
    everything = frame(spark, rows).withColumn("ord", F.struct("batch", "ord")).drop("batch")
    assert got == show(merging.merge_records(everything, "defined_in"))
    relations = str(tmp_path / "relations")
    frame(spark, rows).withColumnRenamed("defined_in", "provenance").write.partitionBy("batch").parquet(relations)
    assert show(ingest.merged(spark, str(tmp_path))[0]) == got


def test_state_without_an_end_is_merged_by_no_python(spark, tmp_path, monkeypatch):
    """A function for each id's group in Python takes about a millisecond for each id: hours for millions."""
    ship(spark)
    monkeypatch.setattr(state, "_merging", None)
    rows = some(5, 6)
    source, out, cp = (str(tmp_path / x) for x in ("entities", "out", "checkpoint"))
    for batches in ([2, 0, 1], [5], [3, 4]):  # late ones too, each time from the same checkpoint
        frame(spark, [r for r in rows if r[0] in batches]).coalesce(1).write.mode("append").partitionBy("batch").parquet(source)
        state.merge_stream(spark, source, out, cp, "defined_in", files=2).awaitTermination()
    got = {r.id: (r.label, [p.asDict() for p in r.defined_in]) for r in state.latest(spark, out).collect()}
    assert got == plain(rows)
