"""WARC archives of pages: written with an index beside them, and read back by the index in coalesced byte ranges.

Writing: every task writes one archive of gzip members, one for each record, under a name of its own, and returns a row
(file, offset, length, url, digest, ...) for each record. Those rows are the index; it is written as a table, and only
files that it names count, so a task that runs again after a lost executor leaves at most a file that nothing refers to.
Of pages with equal payloads the one with the largest id is a response and the others are revisits that refer to it.

Reading: index rows are dealt by file and stretch of the file, to tasks of about ``TASK_BYTES`` of archive, and sorted by offset; neighbouring records are fetched with
one read of at most ``READ_BYTES``, gaps up to ``GAP_BYTES`` included.

Archives and index stand in a folder that all executors share, reached by its URI through pyarrow's file systems.

Defined results: null payload counts as empty; a null id is written as none and read back as null; rows that repeat an id
and a payload are alike (all responses or all revisits); among equal payloads with only null ids all are responses; a null
url is written as empty; an empty table gives an empty index and result. Further columns are not carried.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import BROADCAST_BYTES
from .cluster import scratch

READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
#: Archive bytes that one reading task takes, about.
TASK_BYTES = 128 << 20
#: Payloads of fewer bytes are always responses.
DEDUP_BYTES = 0
ID = "urn:page:"
DATE = "1970-01-01T00:00:00Z"
INDEX = "page_id long, url string, file string, offset long, length long, digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 response, or a revisit whose block has the response's header alone, Content-Length of the full payload included."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{ID}{'none' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <{ID}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    else:
        block += payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzipped(data: bytes) -> bytes:
    c = zlib.compressobj(3, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def parsed(raw: bytes) -> dict:
    """The fields of one gzip member's record: id, type, declared digest and payload length, reference, and the payload if it has one."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = int(next(line.split(b": ", 1)[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length: ")))
    number = lambda v: None if v in (None, f"<{ID}none>") else int(v[len(ID) + 1 : -1])
    revisit = fields["WARC-Type"] == "revisit"
    return {"page_id": number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload_bytes": declared, "refers_to": number(fields.get("WARC-Refers-To")), "payload": None if revisit else payload}


def file_system(uri: str):
    """(file system, path) of a URI or an absolute local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        out, offset = None, 0
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("page_id", "url", "file", "offset", "length", "digest", "record_type", "refers_to")}
            for page_id, url, html, last, revisit in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "last", "revisit")), strict=True):
                payload = (html or "").encode()
                digest = base32_sha1(payload)
                url = " ".join((url or "").split())
                data = gzipped(record(page_id, url, payload, digest, last, revisit))
                out = out or system.open_output_stream(f"{path}/{name}", compression=None)  # members are compressed already
                out.write(data)
                for c, v in zip(rows, (page_id, url, name, offset, len(data), digest, "revisit" if revisit else "response", last if revisit else None), strict=True):
                    rows[c].append(v)
                offset += len(data)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], list(rows))
        if out:
            out.close()

    return run


def with_last(rows: DataFrame, groups: DataFrame, limit: int | None = None) -> DataFrame:
    """rows (page_id, sha, ...) with ``last`` of groups (sha, last, n), one for each payload that several rows have.

    Groups of a counted size of up to ``limit`` bytes are broadcast. Beyond it those with a thousandth of all repeated rows
    or more, at most a thousand, still are, and their rows are dealt by page_id where the others meet their groups by sha:
    no task gets all rows of a frequent payload.
    """
    n = groups.count()
    if n * 64 <= (BROADCAST_BYTES if limit is None else limit):
        return rows.join(F.broadcast(groups.select("sha", "last")), "sha", "left")
    share = (groups.agg(F.sum("n").alias("rows")).first()["rows"] or 0) / 1000
    hot = groups.where(F.col("n") >= share).select("sha", F.col("last").alias("hot"))
    rows = rows.join(F.broadcast(hot), "sha", "left")
    alone = F.concat(F.lit("page "), F.coalesce(F.col("page_id"), F.xxhash64("url")).cast("string")).cast("binary")
    rows = rows.withColumn("by", F.when(F.col("hot").isNull(), F.col("sha")).otherwise(alone))
    rest = groups.where(F.col("n") < share).select(F.col("sha").alias("by"), F.col("last").alias("cold"))
    return rows.join(rest, "by", "left").withColumn("last", F.coalesce("hot", "cold")).drop("by", "hot", "cold")


def write_warc(pages: DataFrame, folder: str | None = None, dedup_bytes: int = DEDUP_BYTES) -> tuple[str, DataFrame]:
    """(folder, index) of the archives written from pages (page_id, url, html)."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.unhex(F.sha1(F.coalesce("html", F.lit("")))).alias("sha"))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    groups = rows.where(size >= dedup_bytes).groupBy("sha").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 and last is not null").select("sha", "last", "n")
    groups.write.parquet(f"{folder}/groups")
    joined = with_last(rows, spark.read.schema("sha binary, last long, n long").parquet(f"{folder}/groups"))
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    written = joined.select("page_id", "url", "html", "last", revisit.alias("revisit")).mapInArrow(_writer(f"{folder}/archives"), INDEX)
    written.write.parquet(f"{folder}/index")
    return folder, spark.read.schema(INDEX).parquet(f"{folder}/index")


def _reader(folder: str):
    def fetched(system, path: str, rows: list[tuple[int, int]]) -> Iterator[bytes]:
        """Each record's bytes, in order, from as few reads as the limits allow."""
        with system.open_input_file(path) as f:
            i = 0
            while i < len(rows):
                lo, end, j = rows[i][0], rows[i][0] + rows[i][1], i + 1
                while j < len(rows) and rows[j][0] - end <= GAP_BYTES and rows[j][0] + rows[j][1] - lo <= READ_BYTES:
                    end, j = max(end, rows[j][0] + rows[j][1]), j + 1
                data = f.read_at(end - lo, lo)
                for offset, length in rows[i:j]:
                    yield data[offset - lo : offset - lo + length]
                i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            out: dict[str, list] = {c: [] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            lo = 0
            while lo < len(files):
                hi = lo
                while hi < len(files) and files[hi] == files[lo]:
                    hi += 1
                for raw in fetched(system, f"{path}/{files[lo]}", list(zip(offsets[lo:hi], lengths[lo:hi], strict=True))):
                    r = parsed(raw)
                    payload = r["payload"]
                    out["page_id"].append(r["page_id"])
                    out["payload_bytes"].append(r["payload_bytes"] if payload is None else len(payload))
                    out["payload_digest"].append(r["digest"] if payload is None else base32_sha1(payload))
                    out["record_type"].append(r["record_type"])
                    out["refers_to"].append(r["refers_to"])
                lo = hi
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    return run


def read_warc(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records that ``index`` selects; responses'
    lengths and digests are those of the payloads read."""
    stretch = F.floor(F.col("offset") / READ_BYTES)
    total = index.agg(F.sum("length")).first()[0] or 0
    # index rows are small and stand for large records, so tasks are counted by archive bytes, and AQE may not merge them
    tasks = max(1, -(-total // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-total // READ_BYTES)))
    dealt = index.select("file", "offset", "length", stretch.alias("at")).repartition(tasks, "file", "at").sortWithinPartitions("file", "offset")
    return dealt.drop("at").mapInArrow(_reader(f"{folder}/archives"), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
