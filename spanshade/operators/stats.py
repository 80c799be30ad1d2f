"""Job statistics: per-file job rows, batch summary, detection reports.

All are ``groupBy`` / global aggregations with map-side partial aggregation;
the grouping keys are files or entity types, so the shuffled data is a few
counters per task whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strategies import strategy_info
from ..sources.sinks import source_name
from .findings import detection_info

JOB_STATUS = ("success", "partial", "failed")


#: Fixed value: the warning about failed payloads.
FAILED_WARNING = " payloads failed to process"


def _detection_config(finding_sources) -> F.Column:
    info = detection_info(finding_sources)
    return F.struct(
        F.lit(info["regex_available"]).alias("regex_available"),
        F.lit(info["comprehend_available"]).alias("comprehend_available"),
        F.lit(info["cer_endpoint"]).alias("cer_endpoint"),
        F.array(*[F.lit(m) for m in info["detection_methods"]]).alias("detection_methods"))


def _redaction_config(strategy) -> F.Column:
    info = strategy_info(strategy)
    return F.struct(
        F.lit(info["current_strategy"]).alias("current_strategy"),
        F.array(*[F.lit(s) for s in info["available_strategies"]]).alias("available_strategies"),
        F.lit(info["strategy_function"]).alias("strategy_function"))


def file_job_rows(payload_rows: DataFrame, file_col: str = "source_file",
                  stats_col: str = "_stats", dest: str | None = None, strategy: str = "placeholder",
                  finding_sources=(), error_col: str = "error") -> DataFrame:
    """One job row per file from redacted payload rows (``_stats`` struct).

    As in the reference job result: processed = total, failed_payloads is
    forced to 0 and the status is ``success`` even when payloads failed; the
    failures only show up as a warning. ``failed_rows`` carries the true count.
    Columns ``began`` and ``ended`` (``text.clock()`` of each row), if there, become the
    file's first and last clock. A row with an error (if there is such a column) and no stats marks an
    unusable file: status ``failed``, the error, and nothing counted for it.
    ``dest``: the output folder; ``dest_file`` is the file's own folder in it.
    """
    s = F.col(stats_col)
    error = F.col(error_col) if error_col in payload_rows.columns else F.lit(None).cast("string")
    order = F.col("payload_ordinal") if "payload_ordinal" in payload_rows.columns else F.lit(0)
    clocks = [(c, f) for c, f in (("began", F.min), ("ended", F.max)) if c in payload_rows.columns]
    agg = payload_rows.groupBy(file_col).agg(
        F.count(s).alias("total_payloads"),
        F.coalesce(F.sum(s["pii_detected"]), F.lit(0)).cast("bigint").alias("total_pii_detected"),
        F.count_if(s["status"] == "failed").alias("failed_rows"),
        F.count_if(s["pii_detected"] > 0).alias("payloads_with_pii"),
        F.min(F.when(error.isNotNull(), F.struct(order.alias("o"), error.alias("error"))))["error"].alias("error"),
        *[f(c).alias(f"{c}_micros") for c, f in clocks],
    )
    ok = F.col("error").isNull()
    none = F.array().cast("array<string>")
    dest_file = F.concat(F.lit(f"{dest}/source_name="), source_name(F.col(file_col))) if dest else F.lit(None).cast("string")
    return agg.select(
        F.col(file_col).alias("source_file"),
        F.when(ok, dest_file).alias("dest_file"),
        "total_payloads",
        F.col("total_payloads").alias("processed_payloads"),
        F.lit(0).cast("bigint").alias("failed_payloads"),
        "total_pii_detected",
        F.col("total_pii_detected").alias("total_pii_redacted"),
        "payloads_with_pii",
        F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.when(ok, none).otherwise(F.array("error")).alias("errors"),
        F.when(F.col("failed_rows") > 0,
               F.array(F.concat(F.col("failed_rows").cast("string"), F.lit(FAILED_WARNING))))
        .otherwise(none).alias("warnings"),
        "failed_rows",
        _detection_config(finding_sources).alias("detection_config"),
        _redaction_config(strategy).alias("redaction_config"),
        *[f"{c}_micros" for c, _ in clocks],
    )


def _iso(micros: F.Column) -> F.Column:
    utc = F.to_utc_timestamp(F.timestamp_micros(micros), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def with_times(job_rows: DataFrame, began: float, ended: float) -> DataFrame:
    """Start and end of each file (UTC ISO text) and the seconds between.

    ``began_micros`` and ``ended_micros``, if there, are the clocks of the task
    that read the file's first row and finished its last; a file without them
    has the job's (epoch seconds). A failed file has 0.0 seconds.
    """
    def micros(col: str, job: float):
        fixed = F.lit(int(job * 1_000_000)).cast("bigint")
        return F.coalesce(F.col(col), fixed) if col in job_rows.columns else fixed

    start, end = micros("began_micros", began), micros("ended_micros", ended)
    seconds = F.when(F.col("status") == "success", (end - start) / F.lit(1_000_000.0)).otherwise(F.lit(0.0))
    return job_rows.withColumns({
        "processing_start": _iso(start), "processing_end": _iso(end), "processing_seconds": seconds,
    }).drop("began_micros", "ended_micros")


def job_summary(job_rows: DataFrame) -> DataFrame:
    """Per-job summary; ``pii_rate`` = detected / total, 0.0 for empty files
    (kept numeric; format it for display only)."""
    return job_rows.select(
        "status", F.col("source_file").alias("file"),
        F.col("processed_payloads").alias("payloads_processed"),
        F.col("total_pii_detected").alias("pii_detected"),
        F.col("total_pii_redacted").alias("pii_redacted"),
        F.coalesce(F.try_divide(F.col("total_pii_detected").cast("double"),
                                F.col("total_payloads")), F.lit(0.0)).alias("pii_rate"))


def batch_summary(job_rows: DataFrame) -> DataFrame:
    ok = F.col("status") == "success"
    times = [F.unix_micros(F.to_timestamp(c)) for c in ("processing_end", "processing_start")]
    seconds = ([((F.max(times[0]) - F.min(times[1])) / F.lit(1_000_000.0)).alias("processing_time")]
               if "processing_start" in job_rows.columns else [])
    return job_rows.agg(*seconds,
        F.count(F.lit(1)).alias("files_total"),
        F.count_if(ok).alias("files_success"),
        F.count_if(~ok).alias("files_failed"),
        F.coalesce(F.sum(F.when(ok, F.col("processed_payloads"))), F.lit(0)).cast("bigint")
        .alias("total_payloads"),
        F.coalesce(F.sum(F.when(ok, F.col("total_pii_detected"))), F.lit(0)).cast("bigint")
        .alias("total_pii"),
    )


def job_rates(job_rows: DataFrame, seconds: float) -> DataFrame:
    """Entities per payload and payloads per second (``seconds`` measured by the
    caller around the action that produced ``job_rows``)."""
    tot = job_rows.agg(F.sum("total_payloads").alias("p"), F.sum("total_pii_detected").alias("e"))
    return tot.select(
        F.try_divide(F.col("e").cast("double"), F.col("p")).alias("entities_per_payload"),
        (F.col("p") / F.lit(float(seconds))).alias("payloads_per_second"),
        F.lit(float(seconds)).alias("processing_seconds"))


def detection_report(rows: DataFrame, entities_col: str = "entities") -> DataFrame:
    """Totals over detected rows: payloads, with/without PII, entities,
    average entities per payload, percent of payloads with PII."""
    n = F.size(F.col(entities_col))
    agg = rows.agg(F.count(F.lit(1)).alias("total_payloads"),
                   F.count_if(n > 0).alias("payloads_with_pii"),
                   F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("total_entities"))
    return agg.select(
        "total_payloads", "payloads_with_pii",
        (F.col("total_payloads") - F.col("payloads_with_pii")).alias("clean_payloads"),
        "total_entities",
        F.try_divide(F.col("total_entities").cast("double"), F.col("total_payloads"))
        .alias("avg_per_payload"),
        F.try_divide(F.lit(100.0) * F.col("payloads_with_pii"), F.col("total_payloads"))
        .alias("pct_with_pii"))


def entity_type_histogram(entities: DataFrame, type_col: str = "entity_type") -> DataFrame:
    """Count per entity type, sorted by type."""
    return (entities.groupBy(F.col(type_col).alias("entity_type"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("entity_type"))


def first_rows(df: DataFrame, order_cols, n: int = 2) -> DataFrame:
    """The first ``n`` rows in key order (a top-n per partition, then of those)."""
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    return df.orderBy(*cols).limit(n)
