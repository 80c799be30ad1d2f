"""External findings (model / service output) merged with the regex detector.

A findings table has one row per span found by an outside detector::

    (<key columns>, field_name, begin_offset, end_offset, type, score, source)

with ``source`` ``COMPREHEND`` (built-in PII service) or ``CER`` (custom
recogniser). The spans are grouped per record (one shuffle on the key, with
map-side partial aggregation), joined to the texts (one equi-join on the key;
Spark broadcasts the grouped side only when AQE measures it under the
broadcast threshold) and merged per row with the regex candidates: the lists
are concatenated in the order REGEX, COMPREHEND, CER and resolved by the same
overlap rule. Entity text is re-cut from the record text by offset, against an
index of byte positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .entities import INTERNAL_TYPE, LIST_ORDINAL, RANK_STRIDE, empty_array, internal
from .merge import let

FINDING_TYPE = ("struct<so:int,begin_offset:int,end_offset:int,type:string,score:double,"
                "source:string,field_name:string>")


def _source_ordinal(source: Column) -> Column:
    expr = F.lit(999)
    for name, o in sorted(LIST_ORDINAL.items(), key=lambda kv: -kv[1]):
        expr = F.when(source == name, F.lit(o)).otherwise(expr)
    return expr


def group_findings(findings: DataFrame, key_cols, out_col: str = "findings") -> DataFrame:
    """One row per key with its findings sorted in merge order
    (source order, then begin, end, type)."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    item = F.struct(
        _source_ordinal(F.col("source")).alias("so"),
        F.col("begin_offset").cast("int").alias("begin_offset"),
        F.col("end_offset").cast("int").alias("end_offset"),
        F.col("type").alias("type"),
        F.col("score").cast("double").alias("score"),
        F.col("source").alias("source"),
        F.col("field_name").alias("field_name"),
    )
    return findings.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias(out_col))


#: Code points per step of the offset index.
STEP = 2048


def _offset_index(text: Column) -> Column:
    """The text in pieces of ``STEP`` code points, the byte each begins at, and all its bytes; linear in the text."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STEP}}}"), F.lit(0))
    starts = let(pieces, lambda ps: F.aggregate(
        ps, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, p: F.struct((acc["at"] + F.octet_length(p)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"]))
    return F.struct(pieces.alias("pieces"), starts.alias("starts"), text.cast("binary").alias("bytes"))


def _byte_at(index: Column, place: Column) -> Column:
    """The byte offset of a code point offset (that of the end, beyond it)."""
    no = F.least(F.floor(place / STEP).cast("int"), F.size(index["starts"]) - 1)
    return F.when(F.size(index["starts"]) == 0, F.lit(0)).otherwise(
        F.get(index["starts"], no) + F.octet_length(F.substring(F.get(index["pieces"], no), F.lit(1), place - no * STEP)))


def findings_to_entities(grouped: Column, text: Column, field_name=None) -> Column:
    """Grouped findings of one record -> internal-layout entities for one field
    (``field_name``: a name or a Column; all findings if None).

    Spans are cut by bytes that an index of the text gives, so the work is
    linear in the text and in the findings.
    """
    arr = F.coalesce(grouped, F.array().cast(f"array<{FINDING_TYPE}>"))
    if field_name is not None:
        arr = F.filter(arr, lambda f: f["field_name"] == field_name)

    def cut(index):
        def ent(f, i):
            begin, end = f["begin_offset"], f["end_offset"]
            ok = (begin >= 0) & (end >= begin) & text.isNotNull()
            at = F.when(ok, F.struct(_byte_at(index, begin).alias("start"), _byte_at(index, end).alias("end")))
            return let(at, lambda b: internal(
                begin, f["so"].cast("bigint") * F.lit(RANK_STRIDE) + i, end,
                F.when(ok, F.substring(index["bytes"], b["start"] + 1, b["end"] - b["start"]).cast("string"))
                .otherwise(F.substring(text, begin + 1, end - begin)),
                f["type"], f["score"], f["source"], F.coalesce(b["start"], F.lit(-1)), F.coalesce(b["end"], F.lit(-1))))
        return lambda fs: F.transform(fs, ent)

    # the index is made only where there is something to cut
    return let(arr, lambda fs: F.when(F.size(fs) > 0, let(_offset_index(F.coalesce(text, F.lit(""))), lambda index: cut(index)(fs)))
               .otherwise(empty_array(INTERNAL_TYPE)))


def cut_spans(text: Column, spans: Column) -> Column:
    """``spans`` (structs with ``start_pos``, ``end_pos``, ``type``, ``source``) with their ``text`` in front, linear like above."""
    def cut(index):
        def one(s):
            begin, end = s["start_pos"], s["end_pos"]
            ok = (begin >= 0) & (end >= begin) & text.isNotNull()
            at = F.when(ok, F.struct(_byte_at(index, begin).alias("start"), _byte_at(index, end).alias("end")))
            return let(at, lambda b: F.struct(
                F.when(ok, F.substring(index["bytes"], b["start"] + 1, b["end"] - b["start"]).cast("string"))
                .otherwise(F.substring(text, begin + 1, end - begin)).alias("text"),
                begin.alias("start_pos"), end.alias("end_pos"), s["type"].alias("type"), s["source"].alias("source")))
        return lambda ss: F.transform(ss, one)

    return let(spans, lambda ss: F.when(F.size(ss) > 0, let(_offset_index(F.coalesce(text, F.lit(""))), lambda index: cut(index)(ss))))


def attach_findings(df: DataFrame, findings: DataFrame | None, key_cols,
                    out_col: str = "findings") -> DataFrame:
    """Left-join the grouped findings onto the records (NULL when none)."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    if findings is None:
        return df.withColumn(out_col, F.lit(None).cast(f"array<{FINDING_TYPE}>"))
    grouped = group_findings(findings, keys, out_col)
    return df.join(grouped, on=keys, how="left")


def detection_info(findings_sources=()) -> dict:
    """Which detectors a job uses (configuration echo for job rows and logs).

    ``findings_sources`` lists the outside sources whose findings are merged
    (``COMPREHEND``, ``CER``); the regex detector is always on.
    """
    srcs = [s.upper() for s in findings_sources]
    methods = ["regex"] + [s.lower() for s in ("COMPREHEND", "CER") if s in srcs]
    return {
        "regex_available": True,
        "comprehend_available": "COMPREHEND" in srcs,
        "cer_endpoint": "CER" in srcs,
        "detection_methods": methods,
    }
