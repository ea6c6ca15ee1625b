"""Spark sessions and shipping this package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that tests and the benchmark use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clausework")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable in Python workers, wherever the driver found it; once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        here = Path(__file__).parent
        to = Path(tempfile.mkdtemp(prefix="clausework-")) / "clausework.zip"
        with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(here.rglob("*.py")):
                z.write(p, p.relative_to(here.parent))
        spark.sparkContext.addPyFile(str(to))
        _SHIPPED.add(app)
    return spark
