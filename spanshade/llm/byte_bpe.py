"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file (a fixed size) is read on the driver and its bytes are broadcast;
each task builds the library's encoder from them. There is no shuffle, and a
task holds one slice of texts at a time.

Texts of more than ``LONG`` code points are cut before the library sees them,
because its splitting regex needs stack and memory in proportion to the text
and fails on long runs of white space. A cut is made only where a match of the
pattern must end whatever stands around:

* behind a character that is no white space and before one that is: no match
  goes on from the one to the other, and none looks back;
* inside a run of white space before other text, ahead of its last character:
  the run's match gives that one character back. So a run of ``RUN`` or more
  is one match of its own, which an encoder without splitting takes;
* between a letter or digit of a script listed in ``SAFE`` and a mark other
  than the apostrophe (contractions begin with it), for text without spaces.

A match longer than a piece (a million letters without a break) stays whole.
These cuts hold for ``PATTERN``; a text under any other pattern is not cut.

Decoding joins the raw bytes of the ids, in bounded runs; the result is binary,
since the bytes of single ids need not be UTF-8.

Defined results: a null or empty text has no ids and decodes to no bytes; a
null id list decodes to no bytes; invalid UTF-8 in a text is read with U+FFFD
in its place; an id that the rank file lacks is an error; repeated rows get
equal results; an empty table gives an empty result; other columns pass
through, and columns with the operator's output names are replaced.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: Fixed value: the pattern that the cuts are proved for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: white space in the sense of the pattern (the Unicode property).
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters and digits whose class no version of Unicode has changed, and marks.
SURE = "0-9A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f\u0410-\u044f\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
MARKS = "!-&(-/:-@\\[-`{-~\u3001\u3002\uff01\uff0c\uff1f"
SAFE = re.compile(rf"(?<=[^{BLANK}])(?=[{BLANK}])|(?<=[{SURE}])(?=[{MARKS}])")
LONG = 100_000
RUN = 10_000
LONG_RUN = re.compile(f"[{BLANK}]{{{RUN},}}")
#: Texts go through in runs of rows of about this many bytes, ids in runs of this many.
SLICE_BYTES = 1_000_000
RUN_IDS = 1 << 17


class Coder:
    """The library's encoder for one rank file, and the cuts of long texts."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x.strip())}
        self.cuts = pattern == PATTERN
        self.words = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.whole = tiktoken.Encoding("match", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= LONG or not self.cuts:
            return np.array(self.words.encode_ordinary(text), np.uint32)
        return np.concatenate([np.array((self.whole if run else self.words).encode_ordinary(p), np.uint32)
                               for run, p in pieces(text)])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.words.decode_bytes(ids[s:s + RUN_IDS].tolist()) for s in range(0, len(ids), RUN_IDS))


def pieces(text: str):
    """``(run, piece)`` of a long text, in order: run says that the piece is one match of white space."""
    at = 0
    for m in LONG_RUN.finditer(text):
        yield from ((False, p) for p in _between(text, at, m.start()))
        at = m.end() - (m.end() < len(text))
        yield True, text[m.start():at]
    yield from ((False, p) for p in _between(text, at, len(text)))


def _between(text: str, at: int, end: int):
    while at < end:
        m = SAFE.search(text, at + LONG, end) if end - at > LONG else None
        to = m.start() if m else end
        yield text[at:to]
        at = to


def _ranks(spark, rank_path: str):
    with open(rank_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _ids_type(packed: bool) -> T.DataType:
    return T.BinaryType() if packed else T.ArrayType(T.IntegerType())


def _id_column(ids: list[np.ndarray], packed: bool) -> pa.Array:
    if packed:
        return pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int32)))


def _coded(docs: DataFrame, rank_path: str, pattern: str, text_col: str, ids_col: str, out_col: str | None,
           packed: bool) -> DataFrame:
    new = [ids_col] + ([out_col] if out_col else [])
    docs = docs.select(*[c for c in docs.columns if c not in new])
    ranks = _ranks(docs.sparkSession, rank_path)
    at, names = docs.columns.index(text_col), [*docs.columns, "__raw", *new]

    def run(batches):
        coder = Coder(ranks.value, pattern)
        raw_at = len(names) - len(new) - 1
        for whole in batches:
            for b in slices(whole, raw_at, SLICE_BYTES):
                ids = [coder.encode(t.decode("utf-8", "replace")) if t else np.empty(0, np.uint32)
                       for t in b.column(raw_at).to_pylist()]
                cols = [*b.columns[:raw_at], _id_column(ids, packed)]
                if out_col:
                    cols.append(pa.array([coder.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, [n for n in names if n != "__raw"])

    fields = [T.StructField(ids_col, _ids_type(packed))] + ([T.StructField(out_col, T.BinaryType())] if out_col else [])
    raw = docs.withColumn("__raw", F.col(docs.columns[at]).cast("binary"))
    return raw.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def encode(docs: DataFrame, rank_path: str, pattern: str = PATTERN, text_col: str = "text", ids_col: str = "ids",
           packed: bool = False) -> DataFrame:
    """``docs`` with the ids of each text: ``array<int>``, or ``packed`` as little-endian unsigned 32-bit integers."""
    return _coded(docs, rank_path, pattern, text_col, ids_col, None, packed)


def round_trip(docs: DataFrame, rank_path: str, pattern: str = PATTERN, text_col: str = "text", ids_col: str = "ids",
               out_col: str = "decoded", packed: bool = False) -> DataFrame:
    """``docs`` with the ids of each text and the bytes decoded from them, in one pass."""
    return _coded(docs, rank_path, pattern, text_col, ids_col, out_col, packed)


def decode(df: DataFrame, rank_path: str, pattern: str = PATTERN, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes (binary) of each id list, packed or not."""
    df = df.select(*[c for c in df.columns if c != out_col])
    ranks = _ranks(df.sparkSession, rank_path)
    at, names = df.columns.index(ids_col), [*df.columns, out_col]
    packed = isinstance(df.schema[ids_col].dataType, T.BinaryType)

    def run(batches):
        coder = Coder(ranks.value, pattern)
        for b in batches:
            out = [coder.decode(np.frombuffer(x.as_buffer(), "<u4") if packed else x.values.to_numpy(zero_copy_only=False))
                   if x.is_valid else b"" for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out_col, T.BinaryType())]))
