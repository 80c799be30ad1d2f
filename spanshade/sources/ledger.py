"""Datasets that grow by committed runs.

``<base>/data/run=<id>`` holds what one run wrote, ``<base>/_committed/<id>``
says that the run is whole; the mark is made last, and readers look only at
marked runs. So a run that died is invisible, its next try under the same id
overwrites it, and a run that is already marked is not written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def run_path(base: str, run_id: str) -> str:
    if not run_id or any(c in run_id for c in "/= ") or run_id[0] in "._":
        raise ValueError(f"not a run id: {run_id!r}")
    return f"{base.rstrip('/')}/data/run={run_id}"


def is_committed(spark: SparkSession, base: str, run_id: str) -> bool:
    p, fs = _fs(spark, f"{base.rstrip('/')}/_committed/{run_id}")
    return fs.exists(p)


def commit(spark: SparkSession, base: str, run_id: str) -> None:
    p, fs = _fs(spark, f"{base.rstrip('/')}/_committed/{run_id}")
    fs.create(p, True).close()


def committed_runs(spark: SparkSession, base: str) -> list[str]:
    """The ids of all whole runs (one name per run)."""
    p, fs = _fs(spark, f"{base.rstrip('/')}/_committed")
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_runs(spark: SparkSession, base: str, schema) -> DataFrame:
    """The rows of all whole runs of a Parquet dataset; none if there is no run yet."""
    paths = [run_path(base, r) for r in committed_runs(spark, base)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def append_run(df: DataFrame, base: str, run_id: str) -> None:
    """Write ``df`` as one run and mark it; nothing happens if the run is marked already."""
    spark = df.sparkSession
    if not is_committed(spark, base, run_id):
        df.write.mode("overwrite").parquet(run_path(base, run_id))
        commit(spark, base, run_id)
