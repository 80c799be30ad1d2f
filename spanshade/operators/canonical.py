"""Canonical hash labels: one label per distinct entity text.

The stateful hash strategy caches its token by entity *text*, so a text seen
again under another type reuses the type label of its first occurrence, in
processing order. Spark keeps the stateless hash by default; this job makes
the first-seen label explicit and global:

1. count the distinct (text, type) pairs, with partial sums, so a hot text (one
   value in a third of all rows) is one row per type before the shuffle. Only
   texts seen under more than one type can change their label;
2. for those texts alone, find the type with the smallest order key;
3. join these labels back on the text: a table of measured size that is small is
   broadcast; else the entity rows are a written table, so adaptive execution
   splits a hot text. All other entities keep their type;
4. regroup per record and splice.

``order_key`` is a struct giving the processing order (e.g. file, payload,
field ordinal, descending start). The entity rows are checkpointed once, so
the detection that produced them runs once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.ledger import append_run, is_committed, read_runs


def canonical_labels(entities: DataFrame, order_key: Column, text_col: str = "text",
                     type_col: str = "entity_type") -> DataFrame:
    """(text, label) for the texts seen under more than one type: the type of
    the first occurrence."""
    pairs = entities.select(F.col(text_col).alias("text"), F.col(type_col).alias("label")).distinct()
    several = materialize(pairs.groupBy("text").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("text"),
                          "canonical-texts")
    own = entities.select(F.col(text_col).alias("text"), F.col(type_col).alias("label"), order_key.alias("o"))
    own = own.join(several, "text", "left_semi")
    # per (text, type) the first place, then the first type: the place decides,
    # and the type rides along in the compared struct
    first = own.groupBy("text", "label").agg(F.min("o").alias("o"))
    return first.groupBy("text").agg(F.min(F.struct("o", "label"))["label"].alias("label"))


#: Label tables up to this size (measured) are broadcast.
BROADCAST_BYTES = 32 << 20
LABEL_TYPE = "text string, label string"


def first_labels(entities: DataFrame, order_key: Column, base: str, run_id: str) -> DataFrame:
    """(text, label) of every text seen so far, by this run and the runs before it.

    The label table below ``base`` grows by committed runs (``sources.ledger``),
    one folder per run with the texts that were new in it; runs must come in
    processing order. A rerun under the same id, or with entities already seen,
    changes nothing. So jobs in sequence give the labels of one job over all.
    """
    spark = entities.sparkSession
    if not is_committed(spark, base, run_id):
        pairs = entities.groupBy(F.col("text"), F.col("entity_type").alias("label")).agg(F.min(order_key).alias("o"))
        first = pairs.groupBy("text").agg(F.min(F.struct("o", "label"))["label"].alias("label"))
        known = read_runs(spark, base, LABEL_TYPE).select("text")
        append_run(first.join(known, "text", "left_anti").where(F.col("text").isNotNull()), base, run_id)
    return read_runs(spark, base, LABEL_TYPE)


def canonical_hash(text: Column, label: Column) -> Column:
    return F.concat(F.lit("["), label, F.lit("_"), F.substring(F.md5(text), 1, 8), F.lit("]"))


def redact_canonical(texts: DataFrame, entities: DataFrame, key_cols, text_col: str = "text",
                     order_cols=None, out_text: str = "redacted_text", label_base: str | None = None,
                     run_id: str | None = None) -> DataFrame:
    """Hash-redact ``texts`` with canonical (first-seen) labels.

    ``entities`` is the long entity table (keys, text, entity_type, start_pos,
    end_pos, confidence, source), e.g. from ``detect_table``; it is joined
    back to ``texts`` on the keys, so the detection itself runs once.
    The processing order is ``order_cols`` (default: the keys), then
    descending start within a record. With ``label_base`` and ``run_id`` the
    labels go on from those of the runs before (``first_labels``).
    """
    from .redact import with_redaction

    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    order_cols = list(order_cols or keys)
    # the entity rows feed both the label aggregation and the join: write them
    # once to the (shared) checkpoint folder instead of detecting twice
    entities = materialize(entities, "canonical-entities")
    order = F.struct(*[F.col(c) for c in order_cols], (-F.col("start_pos")).alias("__ns"))
    labels = canonical_labels(entities, order) if label_base is None else first_labels(entities, order, label_base, run_id)
    labels = materialize(labels, "canonical-labels")
    size = labels.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text") + F.octet_length("label")).alias("bytes")).first()
    if not size.n:
        labelled = entities.withColumn("label", F.col("entity_type"))
    else:  # few labels go to the entities; many meet them in a shuffle join, where a hot text is split
        small = size.bytes <= BROADCAST_BYTES
        labelled = entities.join(F.broadcast(labels) if small else labels, on="text", how="left").withColumn(
            "label", F.coalesce("label", "entity_type"))
    fields = [F.col("text").alias("text"), F.col("label").alias("entity_type"),
              F.col("start_pos").alias("start_pos"), F.col("end_pos").alias("end_pos"),
              F.col("confidence").alias("confidence"), F.col("source").alias("source")]
    if "byte_start" in entities.columns:
        fields += [F.col("byte_start").alias("byte_start"), F.col("byte_end").alias("byte_end")]
    item = F.struct(*fields)
    grouped = labelled.groupBy(*keys).agg(F.collect_list(item).alias("__canon"))
    d = texts.join(grouped, on=keys, how="left")
    d = with_redaction(d, text_col, "__canon", "hash", out_text=out_text,
                       out_records="__canon_records")
    return d.withColumn("n_redacted", F.size("__canon_records")).drop("__canon",
                                                                     "__canon_records")
