"""Payload redaction job: detect + redact every PII text field of a payload row.

Row-preserving projection (no shuffle) unless an external findings table is
given, in which case the findings are grouped per payload and joined once.

Per payload:
* a field is processed when it exists, is a string and is not blank;
* each processed field is detected (regex, plus findings for that field),
  resolved, and redacted right to left; the fields of a row lie in one array
  that one expression walks, so the plan does not grow with their number;
* ``_redaction_metadata`` = (redacted_at, redaction_count, strategy_used,
  redactions[]) when at least one entity was redacted, else NULL; records are
  concatenated in field order and tagged with ``field_name``;
* ``_stats`` = (payload_id, pii_detected, fields_with_pii[], status, error).
  A payload whose given entities cannot be applied (NULL or negative offsets)
  passes through unredacted with status ``failed`` (``on_failure="quarantine"``
  drops its text instead).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.patterns import DEFAULT_CONFIDENCE
from ..functions.strategies import get_strategy
from ..functions.text import is_blank
from ..operators.detect import with_entities_of_texts
from ..operators.entities import ENTITY_FIELDS, PUBLIC_TYPE, empty_array, public_array
from ..operators.findings import attach_findings, findings_to_entities, group_findings
from ..operators.pairing import zip_rows
from ..operators.redact import FIELD_RECORD_TYPE, usable, utc_now, with_redaction_of_texts

# Fixed value: the PII text fields of a payload, in processing order.
PII_FIELDS = ("sentence", "description", "notes", "comments", "transcript")

STATS_TYPE = ("struct<payload_id:string,pii_detected:int,fields_with_pii:array<string>,"
              "status:string,error:string>")


def eligible_fields(df: DataFrame, fields=PII_FIELDS) -> list[str]:
    """Fields that exist and are strings (non-string values are never scanned)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [f for f in fields if isinstance(types.get(f), StringType)]


#: Staged columns: one element per processed field.
TEXTS, ENTITIES = "__ss_texts", "__ss_entities"


def _texts(present) -> Column:
    return F.array(*[F.col(f"`{f}`") for f in present]).cast("array<string>")


def _findings_of_texts(present, blank: bool = False) -> Column:
    """The findings in ``__ss_findings`` as one entity array per field (NULL for a blank field,
    which is never scanned, unless ``blank``)."""
    names = F.array(*[F.lit(f) for f in present]).cast("array<string>")
    return F.zip_with(F.col(TEXTS), names, lambda t, name: F.when(F.lit(blank) | ~is_blank(t), findings_to_entities(
        F.col("__ss_findings"), t, field_name=name)))


def redact_payloads(df: DataFrame, *, fields=PII_FIELDS, strategy: str = "placeholder",
                    findings: DataFrame | None = None, key_cols=("verbatim_id",),
                    id_col: str = "verbatim_id", types=None,
                    confidence: float = DEFAULT_CONFIDENCE, include_original: bool = True,
                    on_failure: str = "passthrough") -> DataFrame:
    """Redacted payloads with ``_redaction_metadata`` and ``_stats`` columns."""
    _check(strategy, on_failure)
    present = eligible_fields(df, fields)
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    d = df
    if findings is not None:
        d = attach_findings(d, findings, keys, "__ss_findings")

    d = d.withColumn(TEXTS, _texts(present))
    extra = None
    if findings is not None:
        extra = "__ss_extra"
        d = d.withColumn(extra, _findings_of_texts(present))
    d = with_entities_of_texts(d, TEXTS, ENTITIES, extra, types=types, confidence=confidence)
    return _redact_given(d, present, strategy, id_col, include_original, on_failure)


def redact_with_entities(df: DataFrame, entities: DataFrame, *, fields=PII_FIELDS, strategy: str = "placeholder",
                         key_cols=("verbatim_id",), id_col: str = "verbatim_id", unmatched: str = "keep",
                         include_original: bool = True, on_failure: str = "passthrough") -> DataFrame:
    """Redaction from a given entity table, without detection.

    ``entities`` has the layout of a findings table (keys, field_name,
    begin_offset, end_offset, type, score, source) and may cover several
    fields; its spans are used as they are. ``unmatched="keep"`` passes
    payloads without entities through; ``"drop"`` pairs both sides by key and
    drops what either has too many of. Entities for unknown payloads never
    matter. Same ``_redaction_metadata`` and ``_stats`` as ``redact_payloads``.
    """
    _check(strategy, on_failure)
    if unmatched not in ("keep", "drop"):
        raise ValueError("unmatched must be 'keep' or 'drop'")
    present = eligible_fields(df, fields)
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    d = df.join(group_findings(entities, keys, "__ss_findings"), on=keys,
                how="left" if unmatched == "keep" else "inner")
    d = d.withColumn(TEXTS, _texts(present)).withColumn("__ss_given", _findings_of_texts(present, blank=True))
    d = d.withColumn(ENTITIES, F.transform("__ss_given", public_array))
    return _redact_given(d, present, strategy, id_col, include_original, on_failure)


#: Detection results of one payload: field name -> entities.
RESULT_TYPE = "map<string,array<struct<text:string,entity_type:string,start_pos:int,end_pos:int,confidence:double,source:string>>>"


def redact_paired(payloads: DataFrame, results: DataFrame, *, payload_order, result_order, fields=PII_FIELDS,
                  entities_col: str = "entities_by_field", strategy: str = "placeholder", id_col: str = "verbatim_id",
                  include_original: bool = True, on_failure: str = "passthrough") -> DataFrame:
    """Redaction of the i-th payload by the i-th detection result (``RESULT_TYPE``); surplus on either side is dropped.

    Results for fields that are missing, no strings or blank are not applied.
    Columns of ``results`` other than ``entities_col`` and its order are ignored.
    """
    _check(strategy, on_failure)
    present = eligible_fields(payloads, fields)
    order = [result_order] if isinstance(result_order, str) else list(result_order)
    slim = results.select(F.col(entities_col).cast(RESULT_TYPE).alias("__ss_results"),
                          *[F.col(c).alias(f"__ss_order_{i}") for i, c in enumerate(order)])
    d = zip_rows(payloads, slim, payload_order, [f"__ss_order_{i}" for i in range(len(order))])
    names = F.array(*[F.lit(f) for f in present]).cast("array<string>")
    unknown = F.lit(-1)
    d = d.withColumn(TEXTS, _texts(present)).withColumn(ENTITIES, F.zip_with(TEXTS, names, lambda t, name: F.transform(
        F.when(~is_blank(t), F.coalesce(F.try_element_at("__ss_results", name), F.array())).otherwise(F.array()),
        lambda e: F.struct(*[e[c].alias(c) for c in ENTITY_FIELDS], unknown.alias("byte_start"), unknown.alias("byte_end")))))
    return _redact_given(d, present, strategy, id_col, include_original, on_failure)


def _check(strategy: str, on_failure: str) -> None:
    get_strategy(strategy)
    if on_failure not in ("passthrough", "quarantine"):
        raise ValueError("on_failure must be 'passthrough' or 'quarantine'")


def _redact_given(d: DataFrame, present, strategy: str, id_col: str, include_original: bool,
                  on_failure: str) -> DataFrame:
    """Redact every field by its entities in ``ENTITIES``; metadata and stats."""
    # entities on a field without text cannot be applied either
    ok = F.forall(F.zip_with(TEXTS, ENTITIES, lambda t, es: usable(es) & (t.isNotNull() | (F.size(es) == 0))), lambda x: x)
    d = d.withColumn("__ss_ok", ok).withColumn("__ss_used", F.transform(
        ENTITIES, lambda es: F.when(F.col("__ss_ok"), es).otherwise(empty_array(PUBLIC_TYPE))))
    d = with_redaction_of_texts(d, TEXTS, "__ss_used", present, "__ss_redacted", "__ss_records", strategy,
                                include_original=include_original)
    records = F.col("__ss_records") if present else empty_array(FIELD_RECORD_TYPE)
    n = F.size(records)
    metadata = F.when(n > 0, F.struct(
        utc_now().alias("redacted_at"),
        n.alias("redaction_count"),
        F.lit(strategy).alias("strategy_used"), records.alias("redactions")))
    counts = F.transform(ENTITIES, F.size)
    pii = F.aggregate(counts, F.lit(0), lambda a, c: a + c)
    names = F.array(*[F.lit(f) for f in present]).cast("array<string>")
    with_pii = F.filter(names, lambda name, i: F.get(F.col(ENTITIES), i).isNotNull() & (F.size(F.get(F.col(ENTITIES), i)) > 0))
    payload_id = (F.coalesce(F.col(id_col).cast("string"), F.lit("unknown"))
                  if id_col in d.columns else F.lit("unknown"))
    failed = ~F.col("__ss_ok")
    stats = F.struct(
        payload_id.alias("payload_id"),
        F.when(failed, F.lit(0)).otherwise(pii).cast("int").alias("pii_detected"),
        F.when(failed, empty_array("string")).otherwise(with_pii).alias("fields_with_pii"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.when(failed, F.lit("unusable entity offsets")).alias("error"),
    )
    out = d.withColumns({"_redaction_metadata": metadata, "_stats": stats,
                         **{f: F.get("__ss_redacted", F.lit(i)) for i, f in enumerate(present)}})
    if on_failure == "quarantine":
        out = out.withColumns({f: F.when(failed, F.lit(None).cast("string"))
                               .otherwise(F.col(f)) for f in present})
    drop = [c for c in out.columns if c.startswith("__ss_")]
    return out.drop(*drop)
