"""Splicing replacements into text and the per-record redaction trail.

Semantics: entities are applied right to left (stable sort by start,
descending, so equal starts keep list order); each one replaces the slice
``[start, end)`` of the *current* text by the strategy's replacement. One
record per entity, in that descending order. Overlapping or out-of-range
entities given by a caller are spliced exactly the same way (slices clamp).

All of it is one ``aggregate`` per row over the row's own entity array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strategies import get_strategy, replacement
from ..functions.text import col_of
from .merge import let

RECORD_FIELDS = ("original_text", "entity_type", "start_pos", "end_pos", "replacement",
                 "confidence", "source")
RECORD_TYPE = (
    "struct<original_text:string,entity_type:string,start_pos:int,end_pos:int,"
    "replacement:string,confidence:double,source:string>"
)
FIELD_RECORD_TYPE = RECORD_TYPE[:-1] + ",field_name:string>"

_TMP = "__ss_red_"
_KEYED_TYPE = ("struct<k:int,i:int," + RECORD_TYPE[len("struct<"):-1]
               + ",byte_start:int,byte_end:int>")


def _desc_with_replacement(entities: Column, strategy, has_bytes: bool) -> Column:
    unknown = F.lit(-1)
    keyed = F.transform(
        entities,
        lambda e, i: F.struct(
            (-e["start_pos"]).alias("k"), i.alias("i"),
            e["text"].alias("original_text"), e["entity_type"].alias("entity_type"),
            e["start_pos"].alias("start_pos"), e["end_pos"].alias("end_pos"),
            replacement(e["text"], e["entity_type"], strategy).alias("replacement"),
            e["confidence"].alias("confidence"), e["source"].alias("source"),
            (e["byte_start"] if has_bytes else unknown).alias("byte_start"),
            (e["byte_end"] if has_bytes else unknown).alias("byte_end"),
        ),
    )
    return F.coalesce(F.sort_array(keyed), F.array().cast(f"array<{_KEYED_TYPE}>"))


def _linear_ok(asc: Column) -> Column:
    """Byte offsets known and starts strictly increasing with disjoint spans:
    then right-to-left splicing equals a left-to-right rebuild."""
    n = F.size(asc)
    pairs = F.zip_with(F.slice(asc, 1, F.greatest(n - 1, F.lit(0))),
                       F.slice(asc, 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: (b["start_pos"] > a["start_pos"])
                       & (b["start_pos"] >= a["end_pos"]) & (b["byte_start"] >= a["byte_end"]))
    return (F.forall(asc, lambda e: (e["byte_start"] >= 0) & (e["byte_end"] >= e["byte_start"])
                     & (e["end_pos"] >= e["start_pos"]))
            & F.forall(pairs, lambda ok: ok))


def linear_splice(binary_text: Column, asc: Column) -> Column:
    """Rebuild the text from byte slices between ascending, disjoint spans:
    O(text + entities), each slice copied once."""
    def piece(e, i):
        prev = F.when(i == 0, F.lit(0)).otherwise(asc[i - 1]["byte_end"])
        gap = F.substring(binary_text, prev + 1, e["byte_start"] - prev).cast("string")
        return F.concat(gap, e["replacement"])
    last_end = F.element_at(asc, -1)["byte_end"]
    tail = F.substring(binary_text, last_end + 1, F.octet_length(binary_text)).cast("string")
    return F.concat(F.array_join(F.transform(asc, piece), ""), tail)


def splice(text: Column, desc_records: Column) -> Column:
    """Apply records (already in application order) to ``text``."""
    return F.aggregate(
        desc_records, text,
        lambda acc, r: F.concat(F.substring(acc, 1, r["start_pos"]), r["replacement"],
                                F.substring(acc, r["end_pos"] + 1, F.length(acc))),
    )


def usable(entities: Column) -> Column:
    """False when an entity cannot be applied (NULL or negative offsets)."""
    return F.coalesce(
        F.forall(entities,
                 lambda e: e["start_pos"].isNotNull() & e["end_pos"].isNotNull()
                 & (e["start_pos"] >= 0) & (e["end_pos"] >= 0)),
        F.lit(True))


def _entity_fields(df: DataFrame, entities_col) -> list[str]:
    if isinstance(entities_col, str) and entities_col in df.columns:
        dtype = df.schema[entities_col].dataType
    else:
        dtype = df.select(col_of(entities_col)).schema[0].dataType
    return list(dtype.elementType.fieldNames())


def _record_fn(field_name, include_original):
    # one-argument lambda: transform passes the index too when it sees two
    def rec(r):
        fields = [
            (r["original_text"] if include_original else F.lit(None).cast("string"))
            .alias("original_text"),
            *[r[f].alias(f) for f in RECORD_FIELDS[1:]],
        ]
        if field_name is not None:
            fields.append(field_name.alias("field_name"))
        return F.struct(*fields)
    return rec


def _redacted(text: Column, desc: Column, binary: Column | None) -> Column:
    """The text with its records (in application order) spliced in; ``binary``: its bytes, if offsets are known."""
    if binary is None:
        return F.when(F.size(desc) == 0, text).otherwise(splice(text, desc))
    return F.when(F.size(desc) == 0, text).otherwise(let(F.reverse(desc), lambda asc: F.when(
        _linear_ok(asc), linear_splice(binary, asc)).otherwise(splice(text, desc))))


# Expressions over columns known by name are the same for every DataFrame;
# building them through the Python-JVM bridge is the slow part of constructing
# a plan, so they are built once.
_EXPR_CACHE: dict = {}


def _memo(key, build):
    if None in key:  # an unnamed Column: its text does not identify it
        return build()
    if key not in _EXPR_CACHE:
        if len(_EXPR_CACHE) > 512:
            _EXPR_CACHE.clear()
        _EXPR_CACHE[key] = build()
    return _EXPR_CACHE[key]


def _strategy_key(strategy):
    """The function itself, held by the cache: a name may be registered again."""
    return get_strategy(strategy) if isinstance(strategy, str) else strategy


def with_redaction_of_texts(df: DataFrame, texts_col: str, entities_col: str, names, out_texts: str,
                            out_records: str, strategy="placeholder", *, include_original: bool = True) -> DataFrame:
    """Redaction of an array of texts by an array of entity arrays.

    ``out_texts`` holds the redacted texts, ``out_records`` all records in one
    array, in the order of the texts, each with its text's name in
    ``field_name``. One expression walks the arrays: the plan is the same for
    any number of texts.
    """
    names = tuple(names)
    has_bytes = "byte_start" in df.schema[entities_col].dataType.elementType.elementType.fieldNames()
    desc, skey = f"{_TMP}descs", _strategy_key(strategy)
    d = df.withColumn(desc, _memo(("descs", entities_col, skey, has_bytes), lambda: F.transform(
        entities_col, lambda es: _desc_with_replacement(es, strategy, has_bytes))))
    texts = _memo(("texts", texts_col, has_bytes), lambda: F.zip_with(
        texts_col, desc, lambda t, r: _redacted(t, r, t.cast("binary") if has_bytes else None)))
    field = F.array(*[F.lit(n) for n in names])
    records = _memo(("all records", names, include_original), lambda: F.flatten(F.transform(
        desc, lambda rs, i: F.transform(rs, _record_fn(F.get(field, i), include_original)))))
    return d.withColumns({out_texts: texts, out_records: records}).drop(desc)


def with_redaction(df: DataFrame, text_col, entities_col, strategy="placeholder", *,
                   out_text: str | None = None, out_records: str = "redactions",
                   field_name: str | None = None, include_original: bool = True) -> DataFrame:
    """Add the redacted text and the redaction records for one text column.

    ``out_text`` defaults to overwriting ``text_col`` (when it is a name).
    Rows without entities keep their text and get an empty record list.
    Entities that carry byte offsets and are ascending and disjoint (all
    detector output) are spliced left to right from byte slices in linear
    time; any other list takes the exact right-to-left form.
    """
    has_bytes = "byte_start" in _entity_fields(df, entities_col)
    name = entities_col if isinstance(entities_col, str) else None
    text_name = text_col if isinstance(text_col, str) else None
    desc, binary = f"{_TMP}desc", f"{_TMP}bin"
    stage = {desc: _memo(("desc", name, _strategy_key(strategy), has_bytes),
                         lambda: _desc_with_replacement(col_of(entities_col), strategy, has_bytes))}
    if has_bytes:
        stage[binary] = col_of(text_col).cast("binary")
    target = out_text or (text_col if isinstance(text_col, str) else "redacted_text")
    outputs = {
        target: _memo(("text", text_name, has_bytes), lambda: _redacted(
            col_of(text_col), F.col(desc), F.col(binary) if has_bytes else None)),
        out_records: _memo(("records", str(field_name), include_original), lambda: F.transform(
            F.col(desc), _record_fn(None if field_name is None else F.lit(field_name), include_original))),
    }
    from .detect import _select_replacing
    return _select_replacing(df.withColumns(stage), outputs, drop=list(stage))


def utc_now() -> Column:
    """The time of the query as UTC ISO text, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                         "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def redaction_result(df: DataFrame, text_col, entities_col, strategy="placeholder",
                     out_col: str = "result") -> DataFrame:
    """RedactionResult struct: original_text, redacted_text, entities_redacted,
    redaction_count, strategy_used, redacted_at."""
    strategy_name = strategy if isinstance(strategy, str) else getattr(strategy, "__name__",
                                                                        "custom")
    d = with_redaction(df, text_col, entities_col, strategy, out_text=f"{_TMP}rt",
                       out_records=f"{_TMP}rr")
    res = F.struct(
        col_of(text_col).alias("original_text"),
        F.col(f"{_TMP}rt").alias("redacted_text"),
        F.col(f"{_TMP}rr").alias("entities_redacted"),
        F.size(F.col(f"{_TMP}rr")).alias("redaction_count"),
        F.lit(strategy_name).alias("strategy_used"),
        utc_now().alias("redacted_at"),
    )
    return d.withColumn(out_col, res).drop(f"{_TMP}rt", f"{_TMP}rr")
