"""SparkSession helpers.

The library never creates or configures a cluster session itself; these
helpers are for tests, the bench and the command-line examples.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "spanshade") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPANSHADE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's ``spark.checkpoint.dir``.

    On a cluster this must name a folder that all executors share; without it
    this raises. Only a ``local`` master, where driver and executors are one
    process, gets a fresh scratch folder instead (tests, the bench).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="spanshade-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # no SparkContext on a Connect session: the conf is enough
        pass
    return d


#: Session option: the number of partitions that the input views are dealt to.
INPUT_PARTITIONS = "spanshade.input.partitions"


def dealt(df, key_cols):
    """``df``, hash-partitioned on its keys if the session sets ``INPUT_PARTITIONS``.

    Text detection is CPU-bound per row, and a small table stored as one
    parquet row group is a single task. Whoever runs on such inputs (the
    bench does) asks for this shuffle; by default there is none, at any size.
    Hash (not round-robin) partitioning keeps task retries deterministic.
    """
    n = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    return df.repartition(int(n), *keys) if n else df


def materialize(df, name: str = "table"):
    """Write ``df`` once as a parquet table under the session's checkpoint
    folder and return it read back.

    Cuts the lineage like ``checkpoint()`` (the data lives in the shared
    folder, so lost executors do not force a recomputation) but computes the
    plan once; an eager ``checkpoint()`` of an unpersisted plan computes it
    twice (once for the action, once for the checkpoint write).

    The caller owns the table: jobs that end with an action drop theirs with
    ``release``; what a lazily returned result still reads stays until the
    ``owning`` block around it ends.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/spanshade-tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.parquet(path)
    _OWNED[id(out)] = (out, path)
    return out


_OWNED: dict = {}


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(table) -> None:
    """Delete a table made by ``materialize``."""
    held = _OWNED.pop(id(table), None)
    if held:
        _delete(table.sparkSession, held[1])


@contextmanager
def owning(spark: SparkSession):
    """Owner of the tables that are materialized inside the block: they are
    deleted at its end, when the results that read them are written. (The
    tables can hold the original text.)"""
    before = set(_OWNED)
    try:
        yield
    finally:
        for key in [k for k in _OWNED if k not in before]:
            release(_OWNED[key][0])
