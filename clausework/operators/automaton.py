"""Many literal patterns in texts at once: an Aho-Corasick machine over a table of patterns, one pass over each text.

The machine is a broadcast of bounded size: patterns are dealt by their hashes to parts of about ``PART_CHARS`` characters, a
part is handed to the tasks, and each Python worker builds its machine once. Texts are read once for each part, so 100,000
terms of usual length take one pass, and its time depends on the texts and on what is found, not on the number of patterns.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Characters of the patterns of one machine; it takes some 50 bytes for each.
PART_CHARS = 1 << 20
#: Machines that a worker keeps.
KEPT = 2
#: Bytes of texts that a worker has as Python strings at once, about, and rows at most.
SLICE_BYTES, SLICE_ROWS = 4 << 20, 1024

_MACHINES: OrderedDict[str, object] = OrderedDict()

#: What is found in a text: the positions behind the last character of each occurrence, by pattern.
Found = dict[str, list[int]]


def machine(patterns: Broadcast) -> object:
    """The machine of a broadcast (name, list of (pattern, carried values ...)), built once in each worker; a pattern gives its rows."""
    import ahocorasick

    name, given = patterns.value
    if name not in _MACHINES:
        made = ahocorasick.Automaton()
        for row in given:
            rows = made.get(row[0], None)
            if rows is None:
                made.add_word(row[0], [row])
            else:
                rows.append(row)
        made.make_automaton()
        _MACHINES[name] = made
        while len(_MACHINES) > KEPT:
            _MACHINES.popitem(last=False)
    _MACHINES.move_to_end(name)
    return _MACHINES[name]


def parts_of(patterns: DataFrame, part_chars: int = PART_CHARS) -> Iterator[list[tuple]]:
    """Rows of a table of patterns, whose first column is the pattern, in parts of about ``part_chars`` characters; null and empty ones in none."""
    pattern = patterns.columns[0]
    rows = patterns.where(F.coalesce(pattern, F.lit("")) != "")
    n = -(-int(rows.agg(F.sum(F.char_length(pattern) + 8)).first()[0] or 0) // part_chars)
    for i in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64(pattern), F.lit(n)) == i).collect()]


def sliced(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded texts, a longer text alone, so that what is found in one is given away before the next is read."""
    ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, min(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), lo + SLICE_ROWS))
        yield batch.slice(lo, hi - lo)
        lo = hi


def matched(texts: DataFrame, text: str, patterns: DataFrame, found: Callable[[str, Iterator[tuple[int, list[tuple]]]], list[tuple]], fields: list[T.StructField], part_chars: int = PART_CHARS) -> DataFrame:
    """texts without ``text``, with ``fields``: a row for each tuple that ``found`` makes of a text and its occurrences.

    ``found`` gets the text and (place of the last character, rows of the pattern) of every occurrence, in order.
    """
    spark = texts.sparkSession
    names = [c for c in texts.columns if c != text]
    schema = T.StructType([*(texts.schema[c] for c in names), *fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def search(patterns: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = machine(patterns)
            for batch in (part for whole in batches for part in sliced(whole, text)):
                at, values = [], []
                for i, t in enumerate(batch.column(text).to_pylist()):
                    rows = found(t, m.iter(t)) if t else []
                    at += [i] * len(rows)
                    values += rows
                if at:
                    kept = batch.take(pa.array(at, pa.int64()))
                    columns = list(zip(*values, strict=True))
                    yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in names), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], schema.names)

        return run

    done = [texts.mapInArrow(search(spark.sparkContext.broadcast((uuid.uuid4().hex, part))), schema) for part in parts_of(patterns, part_chars) if part]
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], schema)


_WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")


def whole_words(text: str, occurrences: Iterator[tuple[int, list[tuple]]]) -> list[tuple]:
    """The carried values of the patterns that stand somewhere between characters that are no ASCII letters, digits or underscores."""
    seen: dict[str, list[tuple]] = {}
    for end, rows in occurrences:
        pattern = rows[0][0]
        if pattern not in seen:
            start = end + 1 - len(pattern)
            if (start == 0 or text[start - 1] not in _WORD) and (end + 1 == len(text) or text[end + 1] not in _WORD):
                seen[pattern] = rows
    return [r[1:] for rows in seen.values() for r in rows]


def anywhere(text: str, occurrences: Iterator[tuple[int, list[tuple]]]) -> list[tuple]:
    """The carried values of the patterns that stand anywhere."""
    seen = {rows[0][0]: rows for _, rows in occurrences}
    return [r[1:] for rows in seen.values() for r in rows]


def terms_in(texts: DataFrame, text: str, terms: DataFrame, term: str = "term", part_chars: int = PART_CHARS) -> DataFrame:
    """texts (all columns but ``text``) by each row of ``terms`` whose term stands in the text as a whole word, with terms' columns."""
    others = [c for c in terms.columns if c != term]
    fields = [T.StructField(f.name, f.dataType) for f in terms.schema.fields if f.name in others] + [T.StructField(term, T.StringType())]
    rows = terms.select(F.col(term).alias("pattern_"), *others, F.col(term).alias("again_"))
    return matched(texts, text, rows, whole_words, fields, part_chars)
