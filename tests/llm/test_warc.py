import base64
import hashlib

from clausework.llm import warc

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", -(1 << 62)), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        top = last.get(h or "")
        revisit = top is not None and i != top and sum((x[2] or "") == (h or "") for x in rows) > 1
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def test_round_trip_with_revisits_nulls_and_long_payloads(spark):
    rows = [(i, f"http://h/{i}", f"<p>é{i % 17}\r\n\r\nWARC/1.1</p>") for i in range(80)] + [(100, None, None), (101, "u v\r\nX: y", ""), (None, "n", "lonely"), (102, "x", "long" * 300_000), (7, "again", "<p>é7\r\n\r\nWARC/1.1</p>")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", digest string").repartition(3)
    folder, index = warc.write_warc(df)
    got = warc.read_warc(spark, folder, index).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)
    some = warc.read_warc(spark, folder, index.where("page_id % 9 = 0")).collect()
    assert {r.page_id for r in some} == {i for i, _, _ in rows if i is not None and i % 9 == 0}


def test_small_payloads_can_stay_whole_and_empty_table(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    folder, index = warc.write_warc(spark.createDataFrame(rows, SCHEMA), dedup_bytes=3)
    assert {(r.page_id, r.record_type) for r in warc.read_warc(spark, folder, index).collect()} == {(1, "response"), (2, "response"), (3, "revisit"), (4, "response")}
    folder, index = warc.write_warc(spark.createDataFrame([], SCHEMA))
    assert index.collect() == [] and warc.read_warc(spark, folder, index).collect() == []


def test_reads_are_coalesced_and_bounded(spark, monkeypatch):
    import pyarrow.fs as fs

    folder, index = warc.write_warc(spark.createDataFrame([(i, "u", f"page {i}") for i in range(50)], SCHEMA).coalesce(1))
    rows = index.orderBy("offset").collect()
    assert [r.offset for r in rows] == [sum(x.length for x in rows[:i]) for i in range(50)]
    system, path = fs.FileSystem.from_uri(folder)
    raw = system.open_input_file(f"{path}/archives/{rows[3].file}").read_at(rows[3].length, rows[3].offset)
    assert warc.parsed(raw)["payload"] == b"page 3"


def test_small_index_rows_of_large_records_are_read_by_many_tasks(spark, monkeypatch):
    import os

    monkeypatch.setattr(warc, "READ_BYTES", 1 << 20)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    rows = spark.createDataFrame([(i, "u", os.urandom(500_000).hex()) for i in range(64)], SCHEMA)
    folder, index = warc.write_warc(rows.coalesce(1))
    assert index.selectExpr("sum(length)").first()[0] >= 30 << 20
    found = warc.read_warc(spark, folder, index)
    from pyspark.sql import functions as F

    tasks = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(t["count"] for t in tasks) == 64


def test_frequent_payloads_are_dealt_by_page(spark):
    from pyspark.sql import functions as F

    ids = spark.range(4000)
    sha = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.concat(F.lit("once"), "id")).otherwise(F.concat(F.lit("pair"), F.floor(F.col("id") / 6)))
    rows = ids.select(F.when(F.col("id") != 9, F.col("id")).alias("page_id"), F.concat(F.lit("u"), "id").alias("url"), sha.cast("binary").alias("sha"))
    groups = rows.groupBy("sha").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    both = [sorted((tuple(r) for r in warc.with_last(rows, groups, limit).select("page_id", "url", "sha", "last").collect()), key=str) for limit in (None, 0)]
    assert both[0] == both[1] and len(both[0]) == 4000 and sum(r[3] is None for r in both[0]) > 100 and sum(r[3] == 3999 for r in both[0]) == 1334
    assert warc.with_last(rows.limit(0), groups.limit(0), -1).count() == 0
