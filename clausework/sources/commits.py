"""Runs made visible at once: their tables are written first, under a name of their own, and one small file then names them.

A manifest ``_runs/spec=S/version=V/run=R/N.json`` holds, for each table, the commit whose folder has the run's rows. The one
with the highest N holds; older ones and their rows stay. A manifest appears by a rename that does not replace, so of two
writers that race for N one fails, and a run that dies between two tables has changed nothing that a reader sees.
"""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

_PLACE = re.compile(r"/_runs/spec=([^/]*)/version=([^/]*)/run=([^/]*)/(\d+)\.json$")
Run = tuple[str, str, str]


class CommitConflict(RuntimeError):
    """Another writer has committed the run meanwhile."""


class Manifests:
    """The manifests under a root, by the file system that its URI names."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._jvm = root.rstrip("/"), spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_runs{below}")

    def _folder(self, run: Run) -> str:
        return "".join(f"/{k}={quote(v, safe='')}" for k, v in zip(("spec", "version", "run"), run, strict=True))

    def numbers(self) -> dict[Run, int]:
        """The highest number of each run."""
        found: dict[Run, int] = {}
        for status in self._fs.globStatus(self._path("/spec=*/version=*/run=*/*.json")) or []:
            m = _PLACE.search(status.getPath().toString())
            if m:
                run = tuple(unquote(x) for x in m.groups()[:3])
                found[run] = max(found.get(run, 0), int(m[4]))
        return found

    def tables(self, run: Run, number: int) -> dict[str, str]:
        """table to commit, as a manifest names them."""
        stream = self._fs.open(self._path(f"{self._folder(run)}/{number:010d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def current(self) -> dict[Run, dict[str, str]]:
        return {run: self.tables(run, n) for run, n in self.numbers().items()}

    def publish(self, run: Run, tables: dict[str, str], after: int) -> None:
        """Makes ``tables`` the run's next manifest, if ``after`` is still its last."""
        final = self._path(f"{self._folder(run)}/{after + 1:010d}.json")
        draft = self._path(f"{self._folder(run)}/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise CommitConflict(f"run {'/'.join(run)} has been committed by another writer")
