"""Queries against their SQL on rows that only larger tables have."""

import datetime

import duckdb
import pytest

import __spark_entry__ as E
from tests.test_catalogue import SF, normal


def differing(spark, folder, name):
    """(rows only Spark has, rows only SQL has) over the tables of a folder, others from the smallest ones."""
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in folder.iterdir():
        con.execute(f"create view {p.stem} as select * from '{p / '*.parquet' if p.is_dir() else p}'")
    df = E.queries()[name](spark, str(folder))
    cursor = con.execute(E.oracle_sql()[name])
    at = [[c[0] for c in cursor.description].index(c) for c in sorted(df.columns)]
    got = sorted((tuple(normal(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    want = sorted((tuple(normal(r[i]) for i in at) for r in cursor.fetchall()), key=repr)
    return [x for x in got if x not in want], [x for x in want if x not in got], len(want)


def linked(folder, *without):
    import os

    for p in os.listdir(SF):
        if p.split(".")[0] not in without:
            (folder / p).symlink_to(f"{SF}/{p}")


@pytest.mark.parametrize("name", ["q_scd2_segments", "q_blips", "q_asof", "q_presence", "q_audit"])
def test_events_in_the_last_half_second_of_a_day(spark, tmp_path, name):
    linked(tmp_path, "events")
    day = datetime.datetime(2024, 1, 3)  # a week of SQL's ends with it
    seconds = (86399.4, 86399.5, 86399.6, 86398.5, 0.0, 43200.5)
    times = [day + datetime.timedelta(days=k * d, seconds=s) for k in (0, 1, 2, 7, 11) for d in (1, 2) for s in seconds]
    rows = [(i, t, i % 3, "view click".split()[i // 2 % 2]) for i, t in enumerate(times)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    only_spark, only_sql, n = differing(spark, tmp_path, name)
    assert n and not only_spark and not only_sql


def test_clauses_whose_anchors_end_in_a_line_feed(spark, tmp_path):
    linked(tmp_path, "documents")
    texts = ["\n" + "abcd e fg.\n" * 20, "\n" + "abcd e fg:\r" * 20, None, "", "one.\n"]
    rows = [(i, t, "en", "src1") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert differing(spark, tmp_path, "q_clause_facts") == ([], [], 10)


def test_chunks_of_more_texts_than_are_held_at_once(spark):
    from pyspark.sql import functions as F

    from clausework.functions import kernels as K
    from clausework.session import ship

    ship(spark)
    n = 2 * K.CUT_ROWS + 7
    rows = spark.range(0, n, 1, 1).select("id", F.when(F.col("id") % 5 > 0, F.repeat(F.concat(F.lit("ab "), "id"), (F.col("id") % 9).cast("int"))).alias("t"))
    got = rows.select("t", K.chunks(10)("t").alias("c")).collect()
    assert len(got) == n and all(r.c == (None if r.t is None else K.chunk(r.t, 10)) for r in got)
