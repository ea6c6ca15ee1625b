"""The shared folder, lineage cuts, and broadcasts behind a check of size."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only on one machine, where that is unset (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("name a folder that all machines share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clausework-"))
        named = spark.sparkContext.getCheckpointDir()
    return named


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/clausework/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """df marked for broadcast if its counted size allows; else as it is, for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
