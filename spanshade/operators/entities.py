"""Entity struct layouts shared by detection, merging and redaction.

Public entity (one element of an ``entities`` array column)::

    struct<text string, entity_type string, start_pos int, end_pos int,
           confidence double, source string, byte_start int, byte_end int>

Offsets are 0-based, half-open, in Unicode code points (Spark ``length`` and
``substring`` count code points too). ``byte_start``/``byte_end`` are the
same span in UTF-8 bytes (-1 when unknown); detection gets them for free and
they let redaction slice the text in linear time.

Internally entities carry a ``rank`` (their position in the concatenated
candidate list: catalogue ordinal, then match order, then external sources)
and are laid out with ``start_pos`` first and ``rank`` second, so the natural
struct ordering of ``sort_array`` is the stable "sort by start" the overlap
resolution needs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTITY_FIELDS = ("text", "entity_type", "start_pos", "end_pos", "confidence", "source")
PUBLIC_FIELDS = ENTITY_FIELDS + ("byte_start", "byte_end")

PUBLIC_TYPE = (
    "struct<text:string,entity_type:string,start_pos:int,end_pos:int,"
    "confidence:double,source:string,byte_start:int,byte_end:int>"
)
INTERNAL_TYPE = (
    "struct<start_pos:int,rank:bigint,end_pos:int,text:string,entity_type:string,"
    "confidence:double,source:string,byte_start:int,byte_end:int>"
)

# rank = list ordinal * RANK_STRIDE + element index within that list
RANK_STRIDE = 1 << 32
LIST_ORDINAL = {"REGEX": 0, "COMPREHEND": 100, "CER": 101}


def empty_array(elem_type: str) -> Column:
    return F.array().cast(f"array<{elem_type}>")


def internal(start, rank, end, text, entity_type, confidence, source,
             byte_start=None, byte_end=None) -> Column:
    unknown = F.lit(-1)
    return F.struct(
        start.cast("int").alias("start_pos"),
        rank.cast("bigint").alias("rank"),
        end.cast("int").alias("end_pos"),
        text.alias("text"),
        entity_type.alias("entity_type"),
        confidence.cast("double").alias("confidence"),
        source.alias("source"),
        (byte_start if byte_start is not None else unknown).cast("int").alias("byte_start"),
        (byte_end if byte_end is not None else unknown).cast("int").alias("byte_end"),
    )


def to_public(e: Column) -> Column:
    return F.struct(*[e[f].alias(f) for f in PUBLIC_FIELDS])


def public_array(arr: Column) -> Column:
    return F.transform(arr, to_public)


def with_rank(arr: Column, list_ordinal: int = 0) -> Column:
    """Public-layout array -> internal layout, rank = list position."""
    base = F.lit(list_ordinal * RANK_STRIDE).cast("bigint")
    return F.transform(
        arr,
        lambda e, i: internal(e["start_pos"], base + i, e["end_pos"], e["text"],
                              e["entity_type"], e["confidence"], e["source"],
                              e["byte_start"], e["byte_end"]),
    )
