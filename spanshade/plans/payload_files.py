"""Payload files derived from the ``conversations`` table.

Writes the payload view (see :mod:`views`) as JSON-array files into
``<dir>/file_id=<n>/``, one file per block of ``CONVERSATIONS_PER_FILE``
conversations and ``TURNS_PER_FILE`` turns. Every file is built from one
bounded group (at most 10 x 1,000 payloads), like the reference format (a
file of up to 15,000 payloads).
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import views

CONVERSATIONS_PER_FILE = 10
TURNS_PER_FILE = 1000
FILE_ID_SQL = (f"CAST(call_id / {CONVERSATIONS_PER_FILE} AS BIGINT) * 100000 "
               f"+ CAST(ordinal / {TURNS_PER_FILE} AS BIGINT)")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's (shared) checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/spanshade-{name}-{uuid.uuid4().hex[:12]}"


# What surrounds a file's array in the mixed set, by remainder of the block of
# conversations: as it is; a final line end; white space around; a second
# array after the first; the array cut short.
MIXED_KINDS = 5
MIXED_SQL = (f"CASE CAST(file_id / 100000 AS BIGINT) % {MIXED_KINDS} "
             "WHEN 1 THEN concat(value, '\n') WHEN 2 THEN concat(' \r\n', value, ' \t\r\n') "
             "WHEN 3 THEN concat(value, ' ', value) WHEN 4 THEN substring(value, 1, length(value) - 1) ELSE value END")


def write_payload_files(spark: SparkSession, sf_dir: str, out_dir: str, mixed: bool = False) -> None:
    """``mixed``: vary what surrounds the arrays, good and bad (``MIXED_SQL``)."""
    p = views.payloads(spark, sf_dir).withColumn("file_id", F.expr(FILE_ID_SQL))
    obj = F.to_json(F.struct("verbatim_id", "call_id", "ordinal", "type", "sentence", "notes"))
    files = (p.groupBy("file_id")
             .agg(F.sort_array(F.collect_list(F.struct("verbatim_id", obj.alias("j"))))
                  .alias("items"))
             .select("file_id", F.concat(F.lit("["), F.array_join(F.col("items.j"), ",\n"),
                                         F.lit("]")).alias("value")))
    if mixed:
        files = files.withColumn("value", F.expr(MIXED_SQL))
    files.repartition("file_id").write.mode("overwrite").partitionBy("file_id").text(out_dir)
