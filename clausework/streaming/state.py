"""Records of a stream merged by id as they come, in state that outlives restarts.

For each id the state holds its first record (by batch and ord, so a late record may replace it) and, for each clause and
anchor, the provenance items of the first record that has them: what ``merging.merge_records`` makes of all records at once.
What a batch touches is put out anew, under the number of the batch; ``latest`` reads the last of it and joins it by id. The
work of a batch follows its rows, not what came before.

State without an end is a streaming aggregation by id, clause and anchor (``merging.anchored``), kept on disk by RocksDB. With
``keep``, state that nothing touches for that long expires, and a record that comes later starts its id anew: that takes
a function of each id's group in Python, whose time follows the number of ids in a batch, about a millisecond for each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import merging

#: The first record's order and fields, and the items by clause and anchor, as JSON: no more than the merged record has.
STATE = "batch long, ord long, row string, items string"
Order = tuple[int, int]


class Known:
    """What is known of one id."""

    def __init__(self, first: tuple[Order, str] | None = None):
        self.first = first
        self.items: dict[str, tuple[Order, list]] = {}

    @staticmethod
    def keyed(items: list[dict]) -> dict[str, list]:
        """(place, item) by clause and anchor."""
        out: dict[str, list] = {}
        for place, item in enumerate(items):
            out.setdefault(json.dumps([item.get("clause"), item.get("anchor")]), []).append([place, item])
        return out

    def add(self, order: Order, row: str, items: list[dict], held) -> dict[str, tuple[Order, list]]:
        """Takes a record in; ``held`` gives the stored items of a key. The keys whose items change, and what they become."""
        if self.first is None or order < self.first[0]:
            self.first = (order, row)
        changed = {}
        for key, mine in self.keyed(items).items():
            known = held(key)
            if known is None or order < known[0]:
                changed[key] = (order, mine)
        return changed


def in_order(parts: list[tuple[Order, list]]) -> list[dict]:
    """The items of all keys by their record's order and their place in it."""
    rows = [(order, place, item) for order, items in parts for place, item in items]
    return [item for *_, item in sorted(rows, key=lambda r: r[:2])]


def _merging(keep_ms: int | None):
    """The function of a group: takes its rows in, and puts the id out if what is known of it changes."""

    def merge(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        known = Known()
        if held.exists:
            batch, ord_, row, items = held.get
            known = Known(((batch, ord_), row))
            known.items = {k: (tuple(order), mine) for k, (order, mine) in json.loads(items).items()}
        before, changed = known.first, False
        for frame in frames:
            for batch, ord_, row, items in zip(frame["batch"], frame["ord"], frame["row"], frame["items"], strict=True):
                new = known.add((int(batch), int(ord_)), row, json.loads(items or "[]"), known.items.get)
                known.items.update(new)
                changed = changed or bool(new)
        if changed or known.first != before:
            held.update((*known.first[0], known.first[1], json.dumps(known.items)))
            yield pd.DataFrame({"id": [key[0]], "batch": [known.first[0][0]], "ord": [known.first[0][1]], "row": [known.first[1]], "items": [json.dumps(in_order(list(known.items.values())))]})
        if keep_ms:
            held.setTimeoutDuration(keep_ms)

    return merge


#: Settings while a query starts: else a state with a timeout asks for one more batch for ever; state stays out of the heap.
SETTINGS = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _expiring(rows: DataFrame, lineage: str, keep_ms: int) -> DataFrame:
    """Whole records of ids as parts with no key, from groups in Python."""
    record, items = T.StructType([f for f in rows.schema.fields if f.name not in ("id", "batch", "ord", lineage)]), rows.schema[lineage].dataType
    texts = rows.select("id", "batch", "ord", F.to_json(F.struct(*record.names)).alias("row"), F.to_json(lineage).alias("items"))
    shape = "id string, batch long, ord long, row string, items string"
    merged = texts.groupBy("id").applyInPandasWithState(_merging(keep_ms), shape, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)
    placed = F.transform(F.from_json("items", items), lambda x, i: F.struct(i.alias("pos"), x.alias("item")))
    none = F.lit(None).cast("struct<clause: string, anchor: string>")
    return merged.select("id", none.alias("k"), F.struct("batch", "ord").alias("o"), F.from_json("row", record).alias("row"), placed.alias(lineage))


def merge_stream(spark: SparkSession, source: str, out: str, checkpoint: str, lineage: str, keep_ms: int | None = None, files: int = 1000) -> StreamingQuery:
    """Merges the records that ``ingest`` writes under ``source/batch=N`` (with a list of provenance ``lineage``) into ``out``.

    A batch that runs again replaces its own updates. A checkpoint is continued with or without ``keep_ms``, as it was begun.
    """
    fields = [f for f in spark.read.parquet(source).schema.fields if f.name != "batch"]
    rows = spark.readStream.schema(T.StructType([*fields, T.StructField("batch", T.LongType())])).option("maxFilesPerTrigger", files).parquet(source)
    rows = rows.withColumn("ord", F.col("ord").cast("long"))
    updates = _expiring(rows, lineage, keep_ms) if keep_ms else merging.anchored(rows, lineage, F.struct("batch", "ord"))

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/update={n}")

    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        return updates.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The merged record of each id, of the last updates of its parts."""
    rows = spark.read.parquet(out)
    parts = merging.first_by(rows, ["id", "k"], F.col("update").cast("long"), last=True).drop("update")
    (lineage,) = (c for c in parts.columns if c not in ("id", "k", "o", "row"))
    return merging.gathered(parts, lineage).withColumn("ord", F.col("ord.ord"))
