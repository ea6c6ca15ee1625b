"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A task builds the encoding once from the rank file, which every machine holds at the same path. Long texts are cut at safe
boundaries first (a white-space character after one that is none: no match of the pattern spans that place, and none
looks back), so the library sees pieces of bounded length and the ids are those of the whole text. Decoding works on raw
bytes: a token may end inside a character, so tokens' bytes are joined before anything is read as UTF-8.

Defined results: null text counts as empty; empty text has no ids; repeated rows and null ids of rows are encoded like any
other; an empty table gives an empty result; input columns with the names of new ones are replaced, others are carried.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Texts above this many characters are cut at safe boundaries.
PIECE_CHARS = 16384


@functools.lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Consecutive parts of text, each of about ``size`` characters, cut only where no match of the pattern can span."""
    lo, n = 0, len(text)
    while n - lo > size:
        cut = lo + size
        while cut < n and not (text[cut] in " \n\t\r" and not text[cut - 1].isspace()):
            cut += 1
        yield text[lo:cut]
        lo = cut
    yield text[lo:]


class Codec:
    """Ids of texts and bytes of ids."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.decimal = [str(i) for i in range(max(ranks.values()) + 1)]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= PIECE_CHARS:
            return self.encoding.encode_ordinary(text)
        return [i for piece in pieces(text) for i in self.encoding.encode_ordinary(piece)]

    def decode(self, ids: list[int] | None) -> bytes:
        return self.encoding.decode_bytes(ids) if ids else b""

    def joined(self, ids: list[int]) -> str:
        return ",".join(map(self.decimal.__getitem__, ids))


def _mapped(df: DataFrame, fields: list[T.StructField], make) -> DataFrame:
    """df's columns and the new ones that ``make`` gives for each Arrow batch, which stay in the input's partitions."""
    df = df.drop(*(f.name for f in fields))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):  # ids and bytes of a few rows at a time
                part = batch.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, *make(part)], [*names, *(f.name for f in fields)])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def bpe_encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """df with ``ids`` array<int>: the ranks of the tokens of every whole text."""

    def make(batch):
        c = codec(ranks_path, pattern)
        return [pa.array([c.encode(t) for t in batch.column(text).to_pylist()], pa.list_(pa.int32()))]

    return _mapped(df, [T.StructField(ids, T.ArrayType(T.IntegerType()))], make)


def bpe_decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """df with ``out`` binary: the bytes of its ids, joined; null ids decode as none."""

    def make(batch):
        c = codec(ranks_path, pattern)
        return [pa.array([c.decode(x) for x in batch.column(ids).to_pylist()], pa.binary())]

    return _mapped(df, [T.StructField(out, T.BinaryType())], make)


def bpe_digests(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(all columns but the text, n_tokens, ids_sha256, decoded_sha256): encoded and decoded in one pass; with keep_ids also
    token_ids array<int>."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))

    def make(batch):
        c, out = codec(ranks_path, pattern), ([], [], [], [])
        for t in batch.column(text).to_pylist():
            ids = c.encode(t)
            out[0].append(len(ids))
            out[1].append(hashlib.sha256(c.joined(ids).encode()).hexdigest())
            out[2].append(hashlib.sha256(c.decode(ids)).hexdigest())
            if keep_ids:
                out[3].append(ids)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()))
        return [pa.array(v, t) for v, t in list(zip(out, kinds, strict=True))[: len(fields)]]

    return _mapped(df, fields, make).drop(text)
