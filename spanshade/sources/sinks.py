"""Writers for redacted payloads and other results.

* JSON Lines, one object per line (UTF-8, non-ASCII kept). A pretty-printed
  single JSON array per file is not a distributed format.
* per-input-file pairing through ``partitionBy`` on a name made from the whole
  input path, so equal base names in different folders stay apart. Rows are
  range-partitioned by file and ordinal before: a file's parts, in the order
  of their names, hold its payloads in order, and one huge file is spread over
  several parts.
* dry run: no output path -> nothing is written, only the statistics.
* ``rewrite_staged``: a new version of a dataset beside the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_name(c) -> F.Column:
    """Output partition value of a file path: base name and a hash of the path.

    Characters that a partition folder's name would escape become ``_``.
    """
    base = F.regexp_replace(F.regexp_extract(c, r"([^/]+)$", 1), r"""[\x00-\x1f\x7f"#%'*:=?\\{\[\]^]""", "_")
    return F.concat(base, F.lit("-"), F.lower(F.lpad(F.hex(F.xxhash64(c)), 16, "0")))


def write_redacted_jsonl(rows: DataFrame, path: str, json_col: str = "redacted_json",
                         file_col: str = "source_file", ordinal_col: str = "payload_ordinal",
                         mode: str = "errorifexists", per_file: bool = True) -> None:
    out = rows.select(F.col(json_col).alias("value"),
                      source_name(F.col(file_col)).alias("source_name"),
                      F.col(ordinal_col).alias("__ord"))
    out = out.repartitionByRange("source_name", "__ord").sortWithinPartitions("source_name", "__ord").drop("__ord")
    w = out.write if per_file else out.drop("source_name").write
    w = w.mode(mode)
    if per_file:
        w = w.partitionBy("source_name")
    w.text(path)


def rewrite_staged(df: DataFrame, base: str, fmt: str = "parquet") -> str:
    """Write ``df`` as the next version below ``base`` and return its path.

    The way to rewrite a dataset that ``df`` itself reads: the old version
    stays whole until the new one is, and ``CURRENT`` names the version to
    read (``current_version``).
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    old = current_version(spark, base)
    name = f"v{int(old.rsplit('/v', 1)[1]) + 1 if old else 1}"
    path = f"{base.rstrip('/')}/{name}"
    df.write.mode("overwrite").format(fmt).save(path)  # an unfinished try may lie there
    mark = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/CURRENT")
    out = mark.getFileSystem(conf).create(mark, True)
    out.write(bytearray(name.encode()))
    out.close()
    return path


def current_version(spark, base: str) -> str | None:
    """Path of the version that ``rewrite_staged`` finished last."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/CURRENT")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        return None
    return f"{base.rstrip('/')}/" + spark.read.text(f"{base.rstrip('/')}/CURRENT").first()[0]
