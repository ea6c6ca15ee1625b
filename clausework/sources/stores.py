"""Clause stores, snapshots, examples, append logs: reading and writing."""

from __future__ import annotations

import re
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ENTITIES, FINDINGS, RELATIONS, REVIEW, SpecConfig
from .commits import Manifests

_CLAUSE = "struct<id:string,key:string,number:string,title:string,level:int,parent:string,text:string,tables:int>"
STORE = f"spec string, version string, release string, source_file string, clause_count int, table_count int, clauses map<string,{_CLAUSE}>"
FACT = "struct<subject:string,subject_type:string,rel:string,object:string,object_type:string,modality:string,confidence:string,anchor:string>"
LOG = f"type string, spec string, version string, model string, prompt_variant string, max_clause_chars int, sentinel boolean, clause string, facts array<{FACT}>, appended long, corrupt string"
#: A run may go on from a log only if these agree.
HEADER = ("spec", "version", "model", "prompt_variant", "max_clause_chars", "sentinel")
SUGGESTIONS = "surface_ord long, surface_id string, surface_label string, surface_type string, canonical_id string, canonical_label string, canonical_type string, exact double, distance double, backend string, proposal string"
#: Types of curated scaffold that an evaluation leaves out.
SCAFFOLD_ENTITIES = ("ProtocolLayer", "Stratum", "DomainRoot", "Release")
SCAFFOLD_RELATIONS = ("IN_LAYER", "BROADER", "NEXT_RELEASE")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by the file system that its URI names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Clauses of JSON stores, in the order of their files' entries, or of a folder that ``write_store`` wrote."""
    if exists(spark, f"{path}/_SUCCESS"):
        columns = "doc_id string, ord int, key string, number string, title string, level int, parent string, text string, tables int, spec string, version string"
        return spark.read.schema(columns).parquet(path).select("doc_id", "spec", "version", "ord", "key", "number", "title", "level", "parent", "text", "tables")
    envelope = spark.read.schema(STORE).json(path, multiLine=True)
    rows = envelope.select("spec", "version", F.posexplode("clauses").alias("ord", "k", "c"))
    return rows.select(F.concat_ws("-", "spec", "version").alias("doc_id"), "spec", "version", "ord", F.col("k").alias("key"), "c.number", "c.title", "c.level", "c.parent", "c.text", F.coalesce("c.tables", F.lit(0)).alias("tables"))


def write_store(clauses: DataFrame, path: str) -> None:
    clauses.write.mode("overwrite").partitionBy("spec", "version").parquet(path)


def store_summary(clauses: DataFrame) -> DataFrame:
    return clauses.agg(F.count(F.lit(1)).alias("clauses"), F.sum("tables").alias("tables"), F.sum(F.char_length(F.coalesce("text", F.lit("")))).alias("chars"))


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """(clause, title, text, facts) of few-shot examples; none if there is no such file."""
    schema = f"clause string, title string, text string, facts array<{FACT}>"
    return spark.read.schema(schema).json(path, multiLine=True) if exists(spark, path) else spark.createDataFrame([], schema)


def without_scaffold(entities: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    return entities.where(~F.col("type").isin(*SCAFFOLD_ENTITIES)), relations.where(~F.col("type").isin(*SCAFFOLD_RELATIONS))


class Snapshots:
    """Runs' results as tables partitioned by specification, version and run, so that runs never touch each other's. A run is
    named by its label; the column is ``run``, as entities have labels of their own.

    All tables of a run are committed together (``commits``): readers see the last commit of each run, whole, and nothing of
    one that did not end. Nothing is overwritten, so a run may be made from itself; older commits stay readable by number.
    """

    TABLES = {"entities": ENTITIES, "relations": RELATIONS, "findings": f"{FINDINGS}, what string, field string, pseudo boolean", "review": REVIEW, "aliases": SUGGESTIONS, "filter": "measure string, n long", "metrics": "phase string, measure string, value double"}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = Manifests(spark, self.root)

    def path(self, table: str, run: tuple[str, str, str], commit: str) -> str:
        spec, version, label = (quote(x, safe=" ") for x in run)
        return f"{self.root}/{table}/spec={spec}/version={version}/run={label}/commit={commit}"

    def commit(self, tables: dict[str, DataFrame], cfg: SpecConfig, label: str = "default") -> int:
        """Writes tables of a run, then shows them all at once; its other tables stay as they are. The commit's number."""
        run, name = (cfg.compact, cfg.version, label), uuid.uuid4().hex
        last = self.manifests.numbers().get(run, 0)
        for table, rows in tables.items():
            rows.write.parquet(self.path(table, run, name))
        before = self.manifests.tables(run, last) if last else {}
        self.manifests.publish(run, before | dict.fromkeys(tables, name), last)
        return last + 1

    def write(self, table: str, rows: DataFrame, cfg: SpecConfig, label: str = "default") -> int:
        """Replaces one table of a run."""
        return self.commit({table: rows}, cfg, label)

    def read(self, table: str, spec: str | None = None, version: str | None = None, label: str | None = None, optional: bool = False, number: int | None = None) -> DataFrame:
        """Rows of one run or of all that the filters leave, as last committed (or as of commit ``number``); a missing optional table is empty."""
        fits = lambda run: all(want in (None, is_) for want, is_ in zip((spec, version, label), run, strict=True))
        runs = {run: n if number is None else number for run, n in self.manifests.numbers().items() if fits(run)}
        paths = [self.path(table, run, tables[table]) for run, n in runs.items() if table in (tables := self.manifests.tables(run, n))]
        shape = f"{self.TABLES[table]}, spec string, version string, run string"
        if not paths:
            if not optional:
                raise FileNotFoundError(f"no {table}{f' of run {label!r}' if label else ''} under {self.root}; run the extraction first")
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(f"{shape}, commit string").option("basePath", f"{self.root}/{table}").parquet(*paths).drop("commit")


class HeaderMismatch(ValueError):
    """The log was made with other parameters than this run's."""


def read_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(headers, records) of an append log of JSON lines: blank and torn lines are skipped, of a clause's records the last holds.

    Lines are in order of their append's number (0 where there is none), then of file and place.
    """
    lines = spark.read.schema(LOG).option("recursiveFileLookup", "true").json(path, columnNameOfCorruptRecord="corrupt", mode="PERMISSIVE")
    good = lines.withColumn("line", F.struct(F.coalesce("appended", F.lit(0)), F.input_file_name(), F.monotonically_increasing_id())).where("corrupt is null")
    headers = good.where("type = 'header'").select("line", *HEADER)
    records = good.where("clause is not null").groupBy("clause").agg(F.max_by("facts", "line").alias("facts"))
    return headers.orderBy(F.desc("line")).limit(1).drop("line"), records


def start_log(spark: SparkSession, path: str, header: dict) -> None:
    """A fresh log with its header."""
    kinds = {"max_clause_chars": "int", "sentinel": "boolean"}
    head = spark.createDataFrame([("header", *[header.get(k) for k in HEADER])], "type string, " + ", ".join(f"{k} {kinds.get(k, 'string')}" for k in HEADER))
    head.coalesce(1).write.mode("overwrite").json(path)


def last_append(spark: SparkSession, path: str) -> int:
    """The number of a log's last append, which names its folder; 0 if there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/append-*")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    return max((int(m[1]) for f in found if (m := re.search(r"append-(\d+)$", f.getPath().getName()))), default=0)


def put_append(records: DataFrame, path: str, number: int) -> None:
    """Append ``number`` of a log: (clause, facts) records, whole or not at all. Putting it again replaces it."""
    numbered = records.select("clause", "facts", F.lit(number).cast("long").alias("appended"))
    numbered.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/append-{number:012d}")


def append_log(records: DataFrame, path: str, header: dict | None = None) -> None:
    """Adds (clause, facts) records, and a header first for a fresh log; a log has one writer at a time."""
    spark = records.sparkSession
    if header is not None:
        start_log(spark, path, header)
    put_append(records, path, last_append(spark, path) + 1)


def check_header(header: DataFrame, current: dict) -> None:
    """Raises if a log's header lacks or differs in any parameter of the current run."""
    row = header.first()
    if row is None:
        raise HeaderMismatch("the log has no header")
    wrong = {k: (row[k], current.get(k)) for k in HEADER if row[k] != current.get(k)}
    if wrong:
        raise HeaderMismatch("; ".join(f"{k}: log {a!r}, run {b!r}" for k, (a, b) in wrong.items()))


def todo(worklist: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clauses still to do, clauses whose facts the log has)."""
    done = records.select(F.col("clause").alias("key"))
    return worklist.join(done, "key", "left_anti"), worklist.join(records.withColumnRenamed("clause", "key"), "key")


def preferred_files(files: DataFrame, order: tuple[str, ...] = (".docx", ".doc")) -> DataFrame:
    """(version, path): for each version the file whose ending comes first in ``order``, equal ones by path."""
    rank = F.lit(len(order))
    for i, ending in reversed(list(enumerate(order))):
        rank = F.when(F.endswith("path", F.lit(ending)), F.lit(i)).otherwise(rank)
    return files.groupBy("version").agg(F.min_by("path", F.struct(rank, "path")).alias("path"))
