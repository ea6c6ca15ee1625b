"""Many patterns at once against plain searches."""

import random
import re
import time

from pyspark.sql import functions as F

from clausework.operators import automaton, corpus, extraction
from clausework.session import ship


def test_terms_are_whole_words(spark):
    r = random.Random(2)
    letters = "ab_. -é9"
    terms = [(i, r.choice("xy"), "".join(r.choices(letters, k=r.randint(1, 4)))) for i in range(120)] + [(500, "x", ""), (501, "x", None), (502, "y", "ab")]
    texts = [(f"k{i}", i, "".join(r.choices(letters, k=r.randint(0, 30)))) for i in range(60)] + [("none", 99, None), ("k1", 1, "ab")]
    clauses = ship(spark).createDataFrame(texts, "key string, ord int, text string")
    table = spark.createDataFrame(terms, "n int, type string, term string")
    want = sorted((k, o, kind, t, n) for k, o, text in texts for n, kind, t in terms if t and re.search(rf"(^|[^A-Za-z0-9_]){re.escape(t)}([^A-Za-z0-9_]|$)", text or ""))
    assert want and sorted(tuple(x) for x in extraction.vocabulary_hits(clauses, terms=table).collect()) == want
    small = automaton.terms_in(clauses.select("key", "ord", "text"), "text", table, part_chars=100)  # many machines
    assert sorted(tuple(x) for x in small.select("key", "ord", "type", "term", "n").collect()) == want


def test_time_does_not_follow_the_number_of_terms(spark):
    texts = ship(spark).range(2000).select(F.col("id").cast("string").alias("key"), F.col("id").alias("ord"), F.concat(F.lit("some text that names T"), "id", F.lit(" and goes on. ")).alias("text"))
    texts = texts.withColumn("text", F.repeat("text", 20)).repartition(4).cache()
    texts.count()
    spent = {}
    for n in (10, 10, 1000, 100_000):
        terms = spark.range(n).select(F.col("id").cast("int").alias("n"), F.lit("Timer").alias("type"), F.concat(F.lit("T"), "id").alias("term"))
        start = time.time()
        assert extraction.vocabulary_hits(texts, terms=terms).count() == min(n, 2000)
        spent[n] = time.time() - start
    assert spent[1000] < 2 * spent[10] + 1 and spent[100_000] < 2 * spent[10] + 6  # the machine is built and sent once


def test_anchors_with_a_common_word_meet_only_where_they_stand(spark):
    items = [(i, f"see the value of field{i}") for i in range(300)] + [(900, ""), (901, None), (902, "of  field7"), (903, " ., "), (904, "one word of field8 more")]
    texts = [(f"k{i}", f"x see the value of field{i} y") for i in range(300)] + [("part", "value of field12 only"), ("none", None)]
    got = {(r.item, r.key, r.exact) for r in corpus.anchored(ship(spark).createDataFrame(items, "item int, anchor string"), spark.createDataFrame(texts, "key string, hay_norm string")).collect()}
    want = set()
    for i, anchor in items:
        a = re.sub(r"^[ .;:,]+|[ .;:,]+$", "", " ".join((anchor or "").split()))
        for k, hay in texts:
            if not anchor:
                want.add((i, k, True))
            elif a and hay:
                tail = " ".join(a.split(" ")[-3:])
                if a in hay or (len(a.split(" ")) >= 4 and tail in hay):
                    want.add((i, k, a in hay))
    assert got == want


def test_no_patterns(spark):
    texts = ship(spark).createDataFrame([("k", "t")], "key string, hay_norm string")
    assert corpus.anchored(spark.createDataFrame([], "item int, anchor string"), texts).count() == 0


def test_texts_are_taken_in_bounded_parts():
    import pyarrow as pa

    texts = [None, "a" * 10, "", "é" * automaton.SLICE_BYTES, *["b" * 2000] * 5000, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    parts = list(automaton.sliced(batch, "t"))
    assert [x for p in parts for x in p.column("i").to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows == 1 or sum(len((x or "").encode()) for x in p.column("t").to_pylist()) <= automaton.SLICE_BYTES for p in parts)
    assert max(p.num_rows for p in parts) <= automaton.SLICE_ROWS and list(automaton.sliced(batch.slice(0, 0), "t")) == []
