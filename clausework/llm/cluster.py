"""Tables in the shared folder and connected components; the rest comes from the library's storage module."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from ..storage import checkpointed, maybe_broadcast, scratch, shared_dir

__all__ = ["checkpointed", "connected_components", "maybe_broadcast", "prepared", "scratch", "shared_dir", "stored"]


#: Rows and bytes of an Arrow batch: texts are long, and both the JVM and the Python worker hold a batch several times over.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("268435456", "8388608")}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with this package shipped to workers and, where nobody set them, Arrow batches of a few megabytes."""
    for name, (default, small) in ARROW_BATCH.items():
        now = str(spark.conf.get(name, default)).lower()
        if now in (default, "256mb", "256m", f"{default}b"):
            spark.conf.set(name, small)
    return ship(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: computed once, and whole if executors are lost."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node id reachable over the undirected edges (a, b).

    A round hooks every node to its smallest neighbour if that is smaller, follows hooks to their ends, and contracts the
    edges to those ends; edges inside a component vanish, so later rounds work on what is left. Minima are aggregations that
    combine before their shuffle and no node's neighbours are gathered in one place. Only nodes that have an edge appear.
    """
    left = checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    found = None
    for _ in range(max_rounds):
        hooks = left.select(F.col("b").alias("node"), F.col("a").alias("to")).union(left.select("a", "a"))
        hooks = checkpointed(hooks.groupBy("node").agg(F.min("to").alias("to")))
        while True:  # to the ends of chains of hooks; each step doubles what is followed
            ahead = hooks.select(F.col("node").alias("to"), F.col("to").alias("end"))
            hooks = checkpointed(hooks.join(ahead, "to").select("node", "to", "end"))
            moved = hooks.where("to <> end").limit(1).count()
            hooks = hooks.select("node", F.col("end").alias("to"))
            if not moved:
                break
        if found is None:
            found = hooks.withColumnRenamed("to", "component")
        else:
            found = found.join(hooks.select(F.col("node").alias("component"), "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        at = lambda c: hooks.select(F.col("node").alias(c), F.col("to").alias(f"{c}_end"))  # noqa: B023, E731
        ends = left.join(at("a"), "a").join(at("b"), "b").select(F.least("a_end", "b_end").alias("a"), F.greatest("a_end", "b_end").alias("b"))
        left = checkpointed(ends.where("a <> b").distinct())
        if not left.limit(1).count():
            return checkpointed(found)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
