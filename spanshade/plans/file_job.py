"""The file job: payload files in, redacted payload files and job rows out.

read (one row per file) -> classify -> explode payloads -> detect + redact
every PII field -> one parquet copy in the shared checkpoint folder (the
scan and the detection run once, and the copy survives lost executors; it is
deleted when the job rows stand) -> write JSON Lines per input file -> one job
row per file, unusable ones included (``groupBy`` over the written rows).
"""

from __future__ import annotations

import time
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stats import file_job_rows, with_times
from ..session import ensure_checkpoint_dir, materialize, release
from ..functions.text import clock
from ..sources.json_files import normalise_path, payload_columns, read_payload_files, redacted_payload_json
from ..sources.ledger import append_run, commit, is_committed, read_runs, run_path
from ..sources.sinks import write_redacted_jsonl
from .payload_job import PII_FIELDS, redact_payloads


def redact_files(payloads: DataFrame, *, fields=PII_FIELDS, strategy: str = "placeholder",
                 findings: DataFrame | None = None, include_original: bool = True, keep=()) -> DataFrame:
    """Payload rows (source_file, payload_ordinal, payload) -> redacted rows
    (source_file, payload_ordinal, redacted_json, _stats, and ``keep``)."""
    cols = payload_columns(payloads, fields)
    red = redact_payloads(cols, fields=fields, strategy=strategy, findings=findings,
                          key_cols=["source_file", "payload_ordinal"], id_col="verbatim_id",
                          include_original=include_original)
    return red.select("source_file", "payload_ordinal",
                      redacted_payload_json("payload", fields).alias("redacted_json"), "_stats", *keep)


def redact_file_rows(rows: DataFrame, **kw) -> DataFrame:
    """``read_payload_files`` rows -> redacted rows; rows of unusable files pass
    with their error and without JSON. ``began`` and ``ended`` are the task's clock
    when it took up the row's file and when it was through with the row."""
    out = redact_files(rows.withColumn("__error", F.col("error")), keep=("__error", "began"), **kw)
    bad = F.col("__error").isNotNull()
    return out.select("source_file", "payload_ordinal", F.when(~bad, F.col("redacted_json")).alias("redacted_json"),
                      F.when(~bad, F.col("_stats")).alias("_stats"), F.col("__error").alias("error"),
                      "began", clock().alias("ended"))


def run_file_job(spark: SparkSession, input_paths, output_dir: str | None = None, *,
                 fields=PII_FIELDS, strategy: str = "placeholder",
                 findings: DataFrame | None = None, finding_sources=(), mode: str = "errorifexists",
                 fmt: str = "json", manifest: DataFrame | None = None) -> DataFrame:
    """Process payload files; returns the job rows (one per input file).

    A JSON Lines file with bad lines fails with the first one's error, in
    ordinal order, and its good lines are still redacted and counted.
    """
    ensure_checkpoint_dir(spark)
    began = time.time()
    rows = read_payload_files(spark, input_paths, fmt, manifest)
    red = materialize(redact_file_rows(rows, fields=fields, strategy=strategy, findings=findings), "redacted-payloads")
    if output_dir:
        write_redacted_jsonl(red.where("redacted_json IS NOT NULL"), output_dir, mode=mode)
    jobs = file_job_rows(red, dest=output_dir, strategy=strategy, finding_sources=finding_sources)
    jobs = materialize(with_times(jobs, began, time.time()), "file-jobs")
    release(red)  # it holds the payloads; the job rows are all that is still read
    return jobs


LEDGER_TYPE = ("source_file string, dest_file string, total_payloads bigint, total_pii_detected bigint, payloads_with_pii bigint, "
               "status string, errors array<string>, warnings array<string>, failed_rows bigint, processing_start string, "
               "processing_end string, processing_seconds double, length bigint, modified timestamp")


def _listed(spark: SparkSession, paths) -> DataFrame:
    """``(source_file, path, length, modified)`` of the input files; contents are not read. Zero-byte files have length 0."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.text(paths, wholetext=True)
    names = spark.createDataFrame([(p, unquote(p)) for p in raw.inputFiles()], "f string, path string").select(
        normalise_path(F.col("f")).alias("source_file"), "path")
    full = spark.read.format("binaryFile").load(paths).select(
        normalise_path(F.col("_metadata.file_path")).alias("source_file"), "length", F.col("modificationTime").alias("modified"))
    return names.join(full, "source_file", "left").select(
        "source_file", "path", F.coalesce("length", F.lit(0).cast("bigint")).alias("length"), "modified")


def run_restartable(spark: SparkSession, input_paths, output_dir: str, run_id: str, **kw) -> DataFrame:
    """The file job with a ledger of finished files; returns this run's job rows.

    Only files without a success in the ledger, or whose length or time of
    change is another, are read. A run writes its output below
    ``<output_dir>/files/data/run=<run_id>`` and its job rows to the ledger
    ``<output_dir>/ledger``, and marks both when they are whole (``ledger``):
    what a killed run left is never visible, and its rerun, under the same id
    or another, gives the same files once. A marked run is not done again.
    ``published`` reads the output.
    """
    files, ledger = f"{output_dir}/files", f"{output_dir}/ledger"
    if is_committed(spark, ledger, run_id):
        return spark.read.schema(LEDGER_TYPE).parquet(run_path(ledger, run_id))
    now = _listed(spark, input_paths)
    done = read_runs(spark, ledger, LEDGER_TYPE).where("status = 'success'").select("source_file", "length", "modified").distinct()
    same = (now.source_file == done.source_file) & (now.length == done.length) & now.modified.eqNullSafe(done.modified)
    todo = materialize(now.join(done, same, "left_anti"), "files-to-do")
    paths = [r.path for r in todo.select("path").collect()]  # the scan needs its paths on the driver
    if paths:
        jobs = run_file_job(spark, paths, run_path(files, run_id), mode="overwrite", **kw)
        jobs = jobs.join(todo, "source_file").selectExpr(*[c.split()[0] for c in LEDGER_TYPE.split(", ")])
    else:
        jobs = spark.createDataFrame([], LEDGER_TYPE)
    commit(spark, files, run_id)
    append_run(jobs, ledger, run_id)
    release(todo)
    return spark.read.schema(LEDGER_TYPE).parquet(run_path(ledger, run_id))


def published(spark: SparkSession, output_dir: str) -> DataFrame:
    """``(value, source_name)``: the redacted payloads of all files, each as its last success left it."""
    ledger = read_runs(spark, f"{output_dir}/ledger", LEDGER_TYPE).where("status = 'success'")
    last = ledger.groupBy("source_file").agg(F.max_by("dest_file", "processing_end").alias("dest_file"))
    paths = [r.dest_file for r in last.collect()]  # one folder per file
    if not paths:
        return spark.createDataFrame([], "value string, source_name string")
    return spark.read.text(paths).select("value", F.regexp_extract(
        F.col("_metadata.file_path"), r"source_name=([^/]+)/", 1).alias("source_name"))
