"""Structured Streaming variant of the file job.

New payload files arriving in a folder are picked up by the file source
(whole-file text), each micro-batch runs the same classification, detection
and redaction as the batch job inside ``foreachBatch`` and writes

* ``<out>/redacted/batch_id=<n>/source_name=<file>-<hash>/part-*`` (JSON Lines) and
* ``<out>/jobs/batch_id=<n>/`` (job rows, parquet),

each with ``overwrite`` of its own batch folder, so a micro-batch that is
replayed after a failure rewrites the same output (idempotent by batch id).
Redaction is stateless: no watermark or state store is needed. Canonical
hash labels are not offered on streams (they need a global order).
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stats import file_job_rows, with_times
from ..plans.file_job import redact_file_rows
from ..session import materialize, release
from ..plans.payload_job import PII_FIELDS
from ..sources.json_files import INVALID, classify_files, normalise_path, payload_rows
from ..sources.sinks import write_redacted_jsonl


def _listed(fs, folder) -> list:
    return list(fs.listStatus(folder))


def _state(spark: SparkSession, out_dir: str, batch_id: int):
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/_arrivals/batch_id={batch_id}.json")
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _new_empty_files(spark: SparkSession, in_dir: str, out_dir: str, batch_id: int) -> DataFrame:
    """Error rows for zero-byte files that no earlier batch has reported (a
    stream's scan skips them, like every scan).

    Each batch leaves a state of the folders it knows, the latest change of
    any, and the empty files told so far; the next lists only folders that
    changed since, so a batch costs what arrived and not what is there (a file
    system without folder times is listed whole). A replayed batch starts from
    the state of the one before it, finds the same files and rewrites its own.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    pattern = fs_path(in_dir)
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    known, mark, told = [], 0, []
    before, state_fs = _state(spark, out_dir, batch_id - 1)
    if state_fs.exists(before):
        state = json.loads("\n".join(r.value for r in spark.read.text(before.toString()).collect()))
        known, mark, told = state["folders"], state["mark"], state["told"]
    met = list(fs.globStatus(pattern) or [])
    empty = {s.getPath().toString() for s in met if s.isFile() and s.getLen() == 0}
    todo = [s for s in met if s.isDirectory()] + [fs.getFileStatus(fs_path(f)) for f in known if fs.exists(fs_path(f))]
    folders, latest = set(), mark
    while todo:
        folder = todo.pop()
        path, changed = folder.getPath().toString(), folder.getModificationTime()
        if path in folders:
            continue
        folders.add(path)
        latest = max(latest, changed)
        if 0 < changed < mark:
            continue
        for f in _listed(fs, folder.getPath()):
            if f.getPath().getName()[0] in "._":
                continue
            if f.isDirectory():
                todo.append(f)
            elif f.getLen() == 0:
                empty.add(f.getPath().toString())
    new = sorted(empty - set(told))
    after, _ = _state(spark, out_dir, batch_id)
    out = state_fs.create(after, True)
    out.write(bytearray(json.dumps({"folders": sorted(folders), "mark": latest, "told": sorted({*told, *new})}).encode()))
    out.close()
    return spark.createDataFrame([(f,) for f in new], "f string").select(
        normalise_path(F.col("f")).alias("source_file"), F.lit(INVALID).alias("error"))


def start_redact_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, *,
                        fields=PII_FIELDS, strategy: str = "placeholder",
                        max_files_per_trigger: int | None = None, available_now: bool = True):
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(in_dir).select("value", F.col("_metadata.file_path").alias("__path"))

    def process(batch: DataFrame, batch_id: int) -> None:
        began = time.time()
        rows = payload_rows(classify_files(batch, path_col="__path"))
        rows = rows.unionByName(_new_empty_files(spark, in_dir, out_dir, batch_id), allowMissingColumns=True)
        red = materialize(redact_file_rows(rows, fields=fields, strategy=strategy),
                          f"stream-batch-{batch_id}")
        out = f"{out_dir}/redacted/batch_id={batch_id}"
        write_redacted_jsonl(red.where("redacted_json IS NOT NULL"), out, mode="overwrite")
        jobs = with_times(file_job_rows(red, dest=out, strategy=strategy), began, time.time())
        jobs.write.mode("overwrite").parquet(f"{out_dir}/jobs/batch_id={batch_id}")
        release(red)

    w = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def redact_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                  **kw) -> DataFrame:
    """Run the stream until the files present now are processed; return the
    job rows written so far."""
    q = start_redact_stream(spark, in_dir, out_dir, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    return spark.read.parquet(f"{out_dir}/jobs")
