"""Documents as they arrive: folded, extracted, and merged into tables of records, exactly once for each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import corpus, extraction, merging
from ..schema import SpecConfig
from ..storage import checkpointed


def read_documents(spark: SparkSession, path: str, schema: str = "doc_id long, text string") -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def ingest(docs: DataFrame, cfg: SpecConfig, out: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch's entities and relations under ``batch=N``: a batch that runs again replaces its own folder."""

    def write(batch: DataFrame, n: int) -> None:
        clauses = corpus.fold_clauses(corpus.document_blocks(batch), F.lit(cfg.spec), F.lit(cfg.version))
        clauses = clauses.withColumn("key", F.concat("doc_id", F.lit(":"), "key")).withColumn("parent", F.concat("doc_id", F.lit(":"), "parent"))
        clauses = checkpointed(clauses)  # folded once for both tables
        entities, relations = extraction.extract(clauses, corpus.relevance(clauses, cfg).where("kept"), cfg)
        for name, rows in (("entities", entities), ("relations", relations)):
            rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={n}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(entities, relations) over all batches, ord as (batch, ord): earlier batches' records come first."""
    result = []
    for name, lineage in (("entities", "defined_in"), ("relations", "provenance")):
        rows = spark.read.parquet(f"{out}/{name}")
        rows = rows.withColumn("ord", F.struct(F.col("batch").cast("long").alias("batch"), "ord")).drop("batch")
        result.append(merging.merge_records(rows, lineage))
    return result[0], result[1]


def windowed_counts(events: DataFrame, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(start, event_type, n) of an event stream or table (ts, event_type): tumbling windows, late rows up to a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, end, n): runs of a user's events with no gap longer than ``gap``."""
    s = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


class Progress:
    """Counts of a stream's batches, for reports while it runs: rows so far, rows a second, and the time that a total still takes."""

    def __init__(self, spark: SparkSession, total: int | None = None):
        from pyspark.sql.streaming import StreamingQueryListener

        progress = self
        self.rows, self.seconds, self.total = 0, 0.0, total

        class Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                progress.add(event.progress.numInputRows, event.progress.batchDuration / 1000)

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        spark.streams.addListener(Listener())

    def add(self, rows: int, seconds: float) -> None:
        self.rows += rows
        self.seconds += seconds

    def report(self) -> str:
        rate = self.rows / self.seconds if self.seconds else 0.0
        left = f", {(self.total - self.rows) / rate:.0f} s left" if self.total and rate else ""
        return f"{self.rows} rows, {rate:.1f} rows/s{left}"
