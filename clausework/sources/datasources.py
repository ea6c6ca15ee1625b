"""Sources for ``spark.read.format``: word-processor files as blocks, and a reply log as a batch or a stream.

    register_sources(spark)
    spark.read.format("worddoc").load(folder)                  # blocks; a file is a partition
    spark.readStream.format("replylog").load(folder)           # records as they are appended; an append is an offset

Folders are any that pyarrow's file systems open by their URI. ``worddoc`` prunes files by filters on doc_id before any is
opened, and drops blocks by filters on kind while reading; Spark hands filters over where
``spark.sql.python.filterPushdown.enabled`` is set, which ``register_sources`` sees to.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from ..schema import BLOCKS
from .documents import word_blocks

RECORD = "append long, clause string, facts string"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else f"file://{path}")


def _heading(style: str) -> int | None:
    m = re.match(r"Heading (\d+)", style)
    return int(m[1]) if m else None


class FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WordReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder
        self.wanted: set[str] | None = None
        self.kinds: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equalities and lists of doc_id and kind; Spark applies the others."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == ("doc_id",):
                self.wanted = values if self.wanted is None else self.wanted & values
            elif values is not None and f.attribute == ("kind",):
                self.kinds = values if self.kinds is None else self.kinds & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, root = _opened(self.folder)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        paths = sorted(f.path for f in found if f.is_file and f.path.lower().endswith(".docx"))
        return [FilePartition(p) for p in paths if self.wanted is None or p[len(root.rstrip("/")) + 1 :] in self.wanted]

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        system, root = _opened(self.folder)
        with system.open_input_file(partition.path) as f:
            blocks = word_blocks(f.read())
        name = partition.path[len(root.rstrip("/")) + 1 :]
        for i, (kind, style, text) in enumerate(blocks):
            if self.kinds is None or kind in self.kinds:
                yield (name, i, kind, style, _heading(style) if kind == "p" else None, text)


class WordSource(DataSource):
    """Blocks (doc_id: the file below the folder, ord, kind, style, level, text) of all .docx files below a folder."""

    @classmethod
    def name(cls) -> str:
        return "worddoc"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema) -> DataSourceReader:
        return WordReader(self.options["path"])


class AppendPartition(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


def _appends(folder: str) -> list[int]:
    system, root = _opened(folder)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(int(m[1]) for f in found if (m := re.fullmatch(r"append-(\d+)", f.base_name)))


def _records(folder: str, number: int) -> Iterator[tuple]:
    """The whole lines of an append; torn ones are left aside."""
    system, root = _opened(folder)
    for f in system.get_file_info(fs.FileSelector(f"{root.rstrip('/')}/append-{number:012d}")):
        if f.is_file and not f.base_name.startswith(("_", ".")):
            with system.open_input_stream(f.path) as stream:
                lines = stream.read().decode("utf-8", "replace").split("\n")
            for line in lines:
                try:
                    record = json.loads(line)
                except ValueError:
                    continue
                if isinstance(record, dict) and record.get("clause") is not None:
                    yield (number, record["clause"], json.dumps(record.get("facts") or [], ensure_ascii=False))


class LogReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [AppendPartition(n) for n in _appends(self.folder)]

    def read(self, partition: AppendPartition) -> Iterator[tuple]:
        return _records(self.folder, partition.number)


class LogStream(DataSourceStreamReader):
    """Offsets are numbers of appends: what is read up to, itself included."""

    def __init__(self, folder: str, start: int):
        self.folder, self.start = folder, start

    def initialOffset(self) -> dict:
        return {"append": self.start}

    def latestOffset(self) -> dict:
        return {"append": max(_appends(self.folder), default=self.start)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [AppendPartition(n) for n in _appends(self.folder) if start["append"] < n <= end["append"]]

    def read(self, partition: AppendPartition) -> Iterator[tuple]:
        return _records(self.folder, partition.number)

    def commit(self, end: dict) -> None:
        pass


class LogSource(DataSource):
    """(append, clause, facts as JSON) of a reply log; option ``after`` leaves out appends up to a number, in a stream."""

    @classmethod
    def name(cls) -> str:
        return "replylog"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DataSourceReader:
        return LogReader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogStream(self.options["path"], int(self.options.get("after", 0)))


def register_sources(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WordSource)
    spark.dataSource.register(LogSource)
