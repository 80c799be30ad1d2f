"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They run over the whole driver tables (``documents``, ``conversations``) via
the views in :mod:`spanshade.plans.views`. Output columns are flat scalars with
explicit names and types, so the DuckDB cross-check can compare them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import patterns_for_type, CATALOGUE
from ..operators.detect import explode_entities, with_candidates, with_entities
from ..operators.entities import ENTITY_FIELDS, RANK_STRIDE
from ..operators.findings import attach_findings, findings_to_entities
from ..operators.merge import resolve_overlaps
from ..operators.redact import with_redaction
from . import views

KEY = ["src", "key"]

DETECT_GROUPS = {
    "detect_email": [0, 1],
    "detect_phone": [2, 3, 4],
    "detect_ssn": [5],
    "detect_zip": [6],
    "detect_address_street": [7],
    "detect_address_city": [8],
    "detect_credit_card": [9],
    "detect_name": [10, 11],
}


def _candidates_query(ordinals):
    pats = [p for p in CATALOGUE if p.ordinal in ordinals]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = views.corpus(spark, sf_dir).select(*KEY, "text")
        d = with_candidates(c, "text", "cand", patterns=pats)
        return (explode_entities(d, KEY, "cand")
                .select(*KEY, (F.col("rank") / F.lit(RANK_STRIDE)).cast("int").alias("pattern_id"),
                        "start_pos", "end_pos", "text"))
    return run


def _explode_entities(d: DataFrame, col: str) -> DataFrame:
    return explode_entities(d, KEY, col).select(*KEY, *ENTITY_FIELDS)


def entities_merged(spark, sf_dir):
    c = views.corpus(spark, sf_dir).select(*KEY, "text")
    return _explode_entities(with_entities(c, "text", "ents"), "ents")


def _hybrid(spark, sf_dir, c=None):
    c = c if c is not None else views.corpus(spark, sf_dir).select(*KEY, "text")
    f = views.findings(spark, sf_dir)
    d = attach_findings(c, f, KEY, "fnd")
    return with_entities(d, "text", "ents",
                         extra=findings_to_entities(F.col("fnd"), F.col("text"), "text"))


def entities_hybrid(spark, sf_dir):
    return _explode_entities(_hybrid(spark, sf_dir), "ents")


def overlap_report(spark, sf_dir):
    """Per text: candidates, candidates overlapping an earlier one (M2), kept."""
    c = views.corpus(spark, sf_dir).select(*KEY, "text")
    d = with_candidates(c, "text", "cand")
    srt = F.sort_array("cand")
    init = F.struct(F.lit(-1).alias("mx"), F.lit(0).alias("n"))
    n_over = F.aggregate(
        srt, init,
        lambda acc, e: F.struct(F.greatest(acc["mx"], e["end_pos"]).alias("mx"),
                                (acc["n"] + F.when(e["start_pos"] < acc["mx"], 1).otherwise(0))
                                .alias("n")),
        lambda acc: acc["n"])
    return d.select(*KEY, F.size("cand").alias("n_candidates"), n_over.alias("n_overlapping"),
                    F.size(resolve_overlaps(F.col("cand"), may_have_empty=False))
                    .alias("n_kept"))


def _redact_query(strategy):
    def run(spark, sf_dir):
        c = views.corpus(spark, sf_dir).select(*KEY, "text")
        d = with_entities(c, "text", "ents")
        d = with_redaction(d, "text", "ents", strategy, out_text="redacted_text")
        return d.select(*KEY, "redacted_text", F.size("redactions").alias("n_redacted"))
    return run


def redact_with_entities(spark, sf_dir):
    """Redaction from a given entities table (findings used as-is, no merge)."""
    c = views.corpus(spark, sf_dir).select(*KEY, "text")
    d = attach_findings(c, views.findings(spark, sf_dir), KEY, "fnd")
    ents = findings_to_entities(F.col("fnd"), F.col("text"), "text")
    d = with_redaction(d.withColumn("ents", ents), "text", "ents", "placeholder",
                       out_text="redacted_text")
    return d.select(*KEY, "redacted_text", F.size("redactions").alias("n_redacted"))


def payloads_with_given_entities(spark, sf_dir):
    """Two fields redacted from a given entity table, paired by key; payloads
    whose offsets cannot be applied pass through as failed."""
    from .payload_job import redact_with_entities as given
    p = views.payloads(spark, sf_dir)
    out = given(p, views.given_entities(p), fields=("sentence", "notes"), unmatched="drop")
    return out.select("verbatim_id", "sentence", "notes",
                      F.coalesce(F.col("_redaction_metadata.redaction_count"), F.lit(0)).alias("redaction_count"),
                      F.col("_stats.status").alias("status"))


def payloads_paired_by_position(spark, sf_dir):
    """The i-th payload redacted by the i-th detection result, once with more payloads and once with more results."""
    from .payload_job import redact_paired
    p = views.payloads(spark, sf_dir)
    few = p.where("ordinal % 4 <> 1")
    out = []
    for case, left, right in (("more payloads", p, few), ("more results", few, p)):
        red = redact_paired(left, views.detection_results(right), payload_order="verbatim_id", result_order="verbatim_id",
                            fields=("sentence", "notes"))
        out.append(red.select(F.lit(case).alias("case"), "verbatim_id", "sentence", "notes",
                              F.col("_stats.pii_detected").alias("pii_detected")))
    return out[0].unionByName(out[1])


def redaction_records(spark, sf_dir):
    c = views.corpus(spark, sf_dir).select(*KEY, "text")
    d = with_redaction(with_entities(c, "text", "ents"), "text", "ents", "placeholder",
                       out_text="redacted_text")
    recs = F.transform("redactions", lambda r, i: F.struct(i.alias("rec_ord"), r.alias("r")))
    r = explode_entities(d.select(*KEY, recs.alias("recs")), KEY, "recs")
    return r.select(*KEY, F.col("rec_ord").cast("int").alias("rec_ord"),
                    *[F.col(f"r.{f}").alias(f) for f in
                      ("original_text", "entity_type", "start_pos", "end_pos", "replacement",
                       "confidence", "source")])


def payload_redaction(spark, sf_dir):
    from .payload_job import redact_payloads
    p = views.payloads(spark, sf_dir)
    out = redact_payloads(p, strategy="placeholder")
    return out.select(
        "verbatim_id", "sentence", "notes",
        F.col("_redaction_metadata.redaction_count").alias("redaction_count"),
        F.col("_redaction_metadata.strategy_used").alias("strategy_used"),
        F.when(F.col("_redaction_metadata").isNotNull(),
               F.size(F.filter("_redaction_metadata.redactions",
                               lambda r: r["field_name"] == "notes"))).alias("notes_records"))


def payload_stats(spark, sf_dir):
    from .payload_job import redact_payloads
    p = views.payloads(spark, sf_dir)
    out = redact_payloads(p, strategy="placeholder")
    return out.select(
        F.col("_stats.payload_id").alias("payload_id"),
        F.col("_stats.pii_detected").alias("pii_detected"),
        F.array_join("_stats.fields_with_pii", ",").alias("fields_with_pii"),
        F.col("_stats.status").alias("status"))


def _corpus_entities(spark, sf_dir):
    c = views.corpus(spark, sf_dir).select(*KEY, "text")
    return with_entities(c, "text", "ents")


def hash_canonical_labels(spark, sf_dir):
    """Hash strategy with first-seen type labels (processing order: src, key,
    descending start)."""
    from ..operators.canonical import redact_canonical
    from ..operators.detect import detect_table
    texts = views.corpus(spark, sf_dir).select(*KEY, "text")
    ents = detect_table(texts, KEY, "text")
    out = redact_canonical(texts, ents, KEY, "text")
    return out.select(*KEY, "redacted_text", "n_redacted")


def job_stats_by_source(spark, sf_dir):
    """Per-file job rows (files = ``source_file`` of the corpus)."""
    from ..operators.stats import file_job_rows
    from .payload_job import redact_payloads
    c = views.corpus(spark, sf_dir)
    red = redact_payloads(c, fields=("text",), key_cols=KEY, id_col="key")
    j = file_job_rows(red)
    return j.select("source_file", "total_payloads", "processed_payloads", "failed_payloads",
                    "total_pii_detected", "total_pii_redacted", "payloads_with_pii", "status",
                    "failed_rows",
                    (F.col("total_pii_detected") / F.col("total_payloads")).alias("pii_rate"))


def batch_summary(spark, sf_dir):
    from ..operators.stats import batch_summary as bs
    return bs(job_stats_by_source(spark, sf_dir))


def detection_report(spark, sf_dir):
    from ..operators.stats import detection_report as dr
    return dr(_corpus_entities(spark, sf_dir), "ents")


def entity_type_histogram(spark, sf_dir):
    from ..operators.stats import entity_type_histogram as h
    return h(explode_entities(_corpus_entities(spark, sf_dir).select(*KEY, "ents"), KEY, "ents"))


def validation_report(spark, sf_dir):
    from ..operators.validate import validation
    d = with_redaction(_corpus_entities(spark, sf_dir), "text", "ents", "placeholder",
                       out_text="redacted_text")
    v = validation("text", "redacted_text", "redactions")
    d = d.select(*KEY, F.size("redactions").alias("n_redacted"), v.alias("v"))
    return explode_entities(
        d.select(*KEY, F.when(F.col("n_redacted") > 0, F.array(F.struct(
            F.col("v.is_valid").alias("is_valid"),
            F.size("v.errors").alias("n_errors"),
            F.size("v.warnings").alias("n_warnings"),
            F.array_join("v.errors", " | ").alias("errors"),
            F.array_join("v.warnings", " | ").alias("warnings")))).alias("r")), KEY, "r")


# Feedback loop: a weaker first pass (no SSN / NAME patterns) and a residual
# scan for the high-risk types.
FIRST_PASS_TYPES = ("EMAIL", "PHONE", "ZIP_CODE", "ADDRESS", "CREDIT_CARD")
RESIDUAL_TYPES = ("EMAIL", "PHONE", "SSN", "CREDIT_CARD", "NAME")
FKEY = KEY + ["source_file"]


def _feedback_base(spark, sf_dir):
    """First pass (weaker detector) + residual scan, one row per record:
    src, key, source_file, redactions (first-pass records), leaks.

    Checkpointed once: every feedback job below reads this table (like the
    redacted output + scan findings of the reference's pipeline) instead of
    re-running both detections per branch."""
    from .feedback import replacement_spans, with_residual_leaks
    c = views.corpus(spark, sf_dir)
    d = with_entities(c, "text", "ents", types=FIRST_PASS_TYPES)
    d = with_redaction(d, "text", "ents", "placeholder", out_text="redacted_text")
    d = d.withColumn("spans", replacement_spans(F.col("redactions")))
    d = with_residual_leaks(d, "redacted_text", "spans", "leaks", types=RESIDUAL_TYPES)
    from ..session import materialize
    return materialize(d.select(*FKEY, "redactions", "leaks"), "feedback-base")


def _leak_rows(base):
    return explode_entities(base.select(*FKEY, "leaks"), FKEY, "leaks")


def residual_leaks(spark, sf_dir):
    return _leak_rows(_feedback_base(spark, sf_dir)).select(
        *FKEY, "entity_type", "start_pos", "end_pos", "text")


def _quarantine(spark, sf_dir, base):
    from .feedback import quarantine
    raw = views.corpus(spark, sf_dir)
    return quarantine(raw, _leak_rows(base))


def quarantine_semi(spark, sf_dir):
    return _quarantine(spark, sf_dir, _feedback_base(spark, sf_dir))[0].select(*FKEY)


def clean_anti(spark, sf_dir):
    return _quarantine(spark, sf_dir, _feedback_base(spark, sf_dir))[1].select(*FKEY)


def _training_examples(spark, sf_dir, base):
    from .feedback import training_examples as te
    q = _quarantine(spark, sf_dir, base)[0]
    fnd = views.findings(spark, sf_dir)
    red = explode_entities(base.select(*KEY, "redactions"), KEY, "redactions")
    return te(q, fnd, red, KEY)


def training_examples(spark, sf_dir):
    return _training_examples(spark, sf_dir, _feedback_base(spark, sf_dir)).select(
        *FKEY, "text", "begin_offset", "end_offset", "type", "source")


def _examples_union(spark, sf_dir):
    base = _feedback_base(spark, sf_dir)
    ex = _training_examples(spark, sf_dir, base).select(
        *FKEY, "text", "type", "source", F.col("begin_offset").alias("start_pos"))
    lk = _leak_rows(base).select(*FKEY, "text", F.col("entity_type").alias("type"),
                                 F.lit("RESIDUAL").alias("source"), "start_pos")
    return ex.unionByName(lk)


def training_dedup(spark, sf_dir):
    from .feedback import training_set
    return training_set(_examples_union(spark, sf_dir))


def training_set_over_runs(spark, sf_dir):
    """The examples of even keys, then all, then all again: the set holds every text and type once."""
    from .feedback import grow_training_set, training_set
    from ..session import materialize
    from .payload_files import scratch_dir
    base = scratch_dir(spark, "training-set")
    examples = materialize(_examples_union(spark, sf_dir), "training-examples")  # three runs read them
    for run, rows in (("first", examples.where("key % 2 = 0")), ("second", examples), ("third", examples)):
        whole = grow_training_set(training_set(rows), base, run)
    return whole.select("text", "type")


def hash_labels_over_runs(spark, sf_dir):
    """Two jobs in sequence, conversations and then documents, over one table of first-seen labels."""
    from ..operators.canonical import redact_canonical
    from ..operators.detect import detect_table
    from .payload_files import scratch_dir
    base = scratch_dir(spark, "labels")
    texts = views.corpus(spark, sf_dir).select(*KEY, "text")
    out = []
    for run in ("conversations", "documents"):
        own = texts.where(F.col("src") == run)
        out.append(redact_canonical(own, detect_table(own, KEY, "text"), KEY, "text", label_base=base, run_id=run)
                   .select(*KEY, "redacted_text", "n_redacted"))
    return out[0].unionByName(out[1])


def leak_alerts(spark, sf_dir):
    from .feedback import leak_alerts as la
    return la(_leak_rows(_feedback_base(spark, sf_dir)))


def review_sample(spark, sf_dir):
    from .feedback import review_sample as rs
    r = rs(_examples_union(spark, sf_dir), 3, ["text", "src", "key", "start_pos", "source"])
    return r.select("type", "text", "src", "key", F.col("sample_rank").cast("int")
                    .alias("sample_rank"))


def quarantine_scan(spark, sf_dir):
    """Scan of quarantined raw records: regex + outside findings, merged."""
    base = _feedback_base(spark, sf_dir)
    q = _quarantine(spark, sf_dir, base)[0].select(*FKEY, "text")
    d = attach_findings(q, views.findings(spark, sf_dir), KEY, "fnd")
    d = with_entities(d, "text", "ents",
                      extra=findings_to_entities(F.col("fnd"), F.col("text"), "text"))
    return explode_entities(d.select(*FKEY, "ents"), FKEY, "ents").select(
        *FKEY, "entity_type", "start_pos", "end_pos", "text", "source")


def job_summary(spark, sf_dir):
    """Per-file summary (status, file, counts, numeric pii_rate)."""
    from ..operators.stats import file_job_rows, job_summary as js
    from .payload_job import redact_payloads
    c = views.corpus(spark, sf_dir)
    return js(file_job_rows(redact_payloads(c, fields=("text",), key_cols=KEY, id_col="key")))


def text_preview(spark, sf_dir):
    """60-character previews of the records that contain PII."""
    from ..functions.text import preview
    d = _corpus_entities(spark, sf_dir).select(*KEY, "text", F.size("ents").alias("n_entities"))
    return explode_entities(
        d.select(*KEY, F.when(F.col("n_entities") > 0, F.array(F.struct(
            preview("text", 60).alias("preview"), "n_entities"))).alias("r")), KEY, "r")


def _file_job_rows(jobs):
    return jobs.select(
        F.regexp_extract("source_file", r"file_id=(\d+)", 1).cast("bigint").alias("file_id"),
        "total_payloads", "total_pii_detected", "payloads_with_pii", "status", "failed_rows")


def json_file_job(spark, sf_dir):
    """Payload JSON files written from ``conversations`` -> file job -> job rows."""
    from .file_job import run_file_job
    from .payload_files import scratch_dir, write_payload_files
    base = scratch_dir(spark, "files")
    write_payload_files(spark, sf_dir, f"{base}/in")
    return _file_job_rows(run_file_job(spark, f"{base}/in/file_id=*/*.txt", f"{base}/out"))


def json_file_job_results(spark, sf_dir):
    """The whole job result of each file: target, counts, configurations, and that its times are in order."""
    from .file_job import run_file_job
    from .payload_files import scratch_dir, write_payload_files
    base = scratch_dir(spark, "results")
    write_payload_files(spark, sf_dir, f"{base}/in", mixed=True)
    jobs = run_file_job(spark, f"{base}/in/file_id=*/*.txt", f"{base}/out", strategy="mask", finding_sources=("CER",))
    joined = lambda c: F.array_join(c, ",")
    return jobs.select(
        F.regexp_extract("source_file", r"file_id=(\d+)", 1).cast("bigint").alias("file_id"), "status",
        F.col("dest_file").isNotNull().alias("has_dest"), "processed_payloads", "failed_payloads", "total_pii_redacted",
        F.size("warnings").alias("n_warnings"),
        F.col("detection_config.regex_available").alias("regex_available"),
        F.col("detection_config.comprehend_available").alias("comprehend_available"),
        F.col("detection_config.cer_endpoint").alias("cer_endpoint"),
        joined("detection_config.detection_methods").alias("detection_methods"),
        F.col("redaction_config.current_strategy").alias("current_strategy"),
        joined("redaction_config.available_strategies").alias("available_strategies"),
        F.col("redaction_config.strategy_function").alias("strategy_function"),
        ((F.col("processing_start") <= F.col("processing_end")) & (F.col("processing_seconds") >= 0)).alias("times_in_order"))


def restarted_file_job(spark, sf_dir):
    """The restartable job over the mixed files, then over the same folder with more files: every file once, as published."""
    from .file_job import published, run_restartable
    from .payload_files import scratch_dir, write_payload_files
    base = scratch_dir(spark, "restart")
    write_payload_files(spark, sf_dir, f"{base}/in", mixed=True)
    first = run_restartable(spark, f"{base}/in/file_id=[0-4]*/*.txt", f"{base}/job", "first")
    second = run_restartable(spark, f"{base}/in/file_id=*/*.txt", f"{base}/job", "second")
    again = run_restartable(spark, f"{base}/in/file_id=*/*.txt", f"{base}/job", "second")
    done = first.where("status = 'success'").unionByName(second).unionByName(again).dropDuplicates(["source_file"])
    out = published(spark, f"{base}/job").select(
        F.col("source_name").alias("name"), F.from_json("value", "verbatim_id bigint").alias("p")).select("name", "p.*")
    jobs = done.select(F.regexp_extract("source_file", r"file_id=(\d+)", 1).cast("bigint").alias("file_id"), "status",
                       F.regexp_extract("dest_file", r"source_name=([^/]+)$", 1).alias("name"))
    return jobs.join(out, "name", "left").select("file_id", "status", "verbatim_id")


def json_file_outcomes(spark, sf_dir):
    """Good and bad files through the file job: status and error of each file,
    and every redacted payload as read back from the JSON output."""
    from .file_job import run_file_job
    from .payload_files import scratch_dir, write_payload_files
    base = scratch_dir(spark, "mixed")
    write_payload_files(spark, sf_dir, f"{base}/in", mixed=True)
    jobs = run_file_job(spark, f"{base}/in/file_id=*/*.txt", f"{base}/out").select(
        F.regexp_extract("source_file", r"file_id=(\d+)", 1).cast("bigint").alias("file_id"),
        F.regexp_extract("dest_file", r"source_name=([^/]+)$", 1).alias("name"), "status",
        F.array_join("errors", " | ").alias("error"))
    schema = "verbatim_id bigint, sentence string, notes string"
    out = spark.read.text(f"{base}/out").select(
        F.col("source_name").alias("name"), F.from_json("value", schema).alias("p")).select("name", "p.*")
    return jobs.join(out, "name", "left").select("file_id", "status", "error", "verbatim_id", "sentence", "notes")


def redact_stream(spark, sf_dir):
    """Same files through the Structured Streaming job (availableNow)."""
    from ..streaming.redact_stream import redact_stream as rs
    from .payload_files import scratch_dir, write_payload_files
    base = scratch_dir(spark, "stream")
    write_payload_files(spark, sf_dir, f"{base}/in")
    jobs = rs(spark, f"{base}/in/file_id=*", f"{base}/out", f"{base}/checkpoint")
    return _file_job_rows(jobs)


def registered() -> dict:
    q = {name: _candidates_query(ords) for name, ords in DETECT_GROUPS.items()}
    q.update({
        "entities_merged": entities_merged,
        "entities_hybrid": entities_hybrid,
        "overlap_report": overlap_report,
        "redact_placeholder": _redact_query("placeholder"),
        "redact_mask": _redact_query("mask"),
        "redact_remove": _redact_query("remove"),
        "redact_hash": _redact_query("hash"),
        "redact_partial": _redact_query("partial"),
        "redact_with_entities": redact_with_entities,
        "payloads_with_given_entities": payloads_with_given_entities,
        "payloads_paired_by_position": payloads_paired_by_position,
        "redaction_records": redaction_records,
        "payload_redaction": payload_redaction,
        "payload_stats": payload_stats,
        "hash_canonical_labels": hash_canonical_labels,
        "job_stats_by_source": job_stats_by_source,
        "batch_summary": batch_summary,
        "detection_report": detection_report,
        "entity_type_histogram": entity_type_histogram,
        "validation_report": validation_report,
        "residual_leaks": residual_leaks,
        "quarantine_semi": quarantine_semi,
        "clean_anti": clean_anti,
        "training_examples": training_examples,
        "training_dedup": training_dedup,
        "leak_alerts": leak_alerts,
        "review_sample": review_sample,
        "quarantine_scan": quarantine_scan,
        "job_summary": job_summary,
        "text_preview": text_preview,
        "json_file_job": json_file_job,
        "json_file_outcomes": json_file_outcomes,
        "json_file_job_results": json_file_job_results,
        "restarted_file_job": restarted_file_job,
        "training_set_over_runs": training_set_over_runs,
        "hash_labels_over_runs": hash_labels_over_runs,
        "redact_stream": redact_stream,
    })
    return q


__all__ = ["registered", "patterns_for_type"]
