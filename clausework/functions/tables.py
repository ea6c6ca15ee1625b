"""Table functions for SQL text and lateral joins: the chunks of a text, and the facts of a reply, as rows.

    SELECT d.doc_id, c.part, c.chunk FROM documents d, LATERAL chunk_rows(d.text, 6000) c

Null arguments have no rows; an empty text has one empty chunk, and a reply without facts none.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from .kernels import FACT_FIELDS, _fact, chunk, read_reply, without_reasoning


def _text(argument: AnalyzeArgument, name: str) -> None:
    if not isinstance(argument.dataType, T.StringType | T.NullType):
        raise ValueError(f"{name} must be a string, not {argument.dataType.simpleString()}")


class ChunkRows:
    """chunk_rows(text, limit): (part, chunk), whole lines packed greedily, from part 0."""

    @staticmethod
    def analyze(text: AnalyzeArgument, limit: AnalyzeArgument) -> AnalyzeResult:
        _text(text, "text")
        if not isinstance(limit.dataType, T.IntegralType):
            raise ValueError(f"limit must be a whole number, not {limit.dataType.simpleString()}")
        if limit.isConstantExpression and limit.value is not None and limit.value < 1:
            raise ValueError("limit must be 1 or more")
        return AnalyzeResult(T.StructType([T.StructField("part", T.IntegerType()), T.StructField("chunk", T.StringType())]))

    def eval(self, text: str | None, limit: int | None) -> Iterator[tuple[int, str]]:
        if text is not None and limit is not None:
            yield from enumerate(chunk(text, limit))


class FactRows:
    """fact_rows(reply): (pos, and a fact's fields) of the facts that a reply states, reasoning left aside."""

    @staticmethod
    def analyze(reply: AnalyzeArgument) -> AnalyzeResult:
        _text(reply, "reply")
        return AnalyzeResult(T.StructType([T.StructField("pos", T.IntegerType()), *(T.StructField(f, T.StringType()) for f in FACT_FIELDS)]))

    def eval(self, reply: str | None) -> Iterator[tuple]:
        _, items = read_reply(without_reasoning(reply)) if reply else ("", None)
        facts = [f for f in map(_fact, items or []) if f]
        for pos, fact in enumerate(facts):
            yield (pos, *(fact[f] for f in FACT_FIELDS))


def register_tables(spark: SparkSession) -> None:
    """Makes chunk_rows and fact_rows known to SQL text of the session."""
    spark.udtf.register("chunk_rows", udtf(ChunkRows))
    spark.udtf.register("fact_rows", udtf(FactRows))
