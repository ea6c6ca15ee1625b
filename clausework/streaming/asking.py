"""A model asked for a worklist, its replies kept as they come.

The worklist is written as files of a few clauses each, in order, and asked file by file with a bounded number of files per
batch. A batch's replies are committed to the log, under a number that belongs to the batch, before the next batch starts. A
model that fails ends the run, but only after what it had answered in that batch is in the log.

Batches grow with what is done, as long as they are quick: the next one is up to 1/``SHARE`` of what the log got before it. So
their number follows the logarithm of the worklist, and a run that dies loses that share of its work or ``QUICK`` seconds.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import unpacked
from ..sources import stores
from ..storage import checkpointed, scratch

#: Clauses of one batch, at least; and as many as there are cores, that none idles.
LEAST_BATCH = 10
#: A batch is at most this part of what was done before it, if that is more than asked for; none grows after one that took so many seconds.
SHARE, QUICK = 8, 60.0
#: Files of a worklist, about.
MOST_FILES = 4000


def write_worklist(work: DataFrame, folder: str, per_file: int) -> list[tuple[str, int]]:
    """work (ord, key, title, text) as files of at most ``per_file`` rows, more only where there would be too many files; the files in order, with a bound of their rows."""
    rows = work.select(F.col("ord").cast("long").alias("ord"), "key", "title", "text")
    n = rows.count()
    per_file = max(per_file, -(-n // MOST_FILES))
    rows.repartitionByRange(max(1, -(-n // per_file)), "ord", "key").write.option("maxRecordsPerFile", per_file).parquet(folder)
    return [(path, per_file) for path in sorted(work.sparkSession.read.parquet(folder).inputFiles())] if n else []


def next_batch(batch: int, last: int, seconds: float, done: int) -> int:
    """The size of the batch after one of size ``last`` that took ``seconds``, with ``done`` clauses behind it."""
    grown = max(batch, done // SHARE)
    return grown if seconds < QUICK else min(grown, max(batch, last))


def ask_all(work: DataFrame, answer: Callable[[DataFrame], DataFrame], log: str, batch: int | None = None, seen: Callable[[DataFrame, int], None] | None = None) -> None:
    """Asks for every clause of ``work`` and appends to ``log``; raises what the model raised, once the rest of its batch is kept.

    ``answer`` turns clauses into (clause_ord, clause, facts, error): facts where all of a clause's requests were answered, an
    error where one failed. ``seen`` is told each batch's rows and number. ``batch`` is the size of the first batches.
    """
    spark = work.sparkSession
    cores = spark.sparkContext.defaultParallelism
    batch = batch or max(LEAST_BATCH, cores)
    files = write_worklist(work, scratch(spark, "worklist"), max(1, batch // cores))
    start, n, done, at, size = stores.last_append(spark, log), 0, 0, 0, batch
    while at < len(files):
        began = time.monotonic()
        some = files[at : at + max(1, size // files[at][1])]
        rows = spark.read.schema("ord long, key string, title string, text string").parquet(*(path for path, _ in some))
        got = checkpointed(answer(rows))  # asked once, whatever reads it
        stores.put_append(got.where("error is null"), log, start + n + 1)
        if seen:
            seen(got, n)
        wrong = got.where("error is not null").agg(F.min("error").alias("e")).first().e
        if wrong is not None:
            raise unpacked(wrong)
        at, n, done = at + len(some), n + 1, done + sum(most for _, most in some)
        size = next_batch(batch, size, time.monotonic() - began, done)
