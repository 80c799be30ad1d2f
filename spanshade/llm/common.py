"""Helpers shared by the operators: tables, staged results, batch plumbing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract: space and U+0009 to U+000D.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a ``local`` master without that setting gets a folder of its own; on
    a cluster a machine-local folder would lose data, so a missing setting is
    an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        d = tempfile.mkdtemp(prefix="spanshade-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    _OWNED.append(path)
    return path


#: Paths of the intermediate tables of this process, oldest first.
_OWNED: list[str] = []


class Owner:
    """The intermediate tables that are made while it is open.

    A lazily returned result reads some of them, so they stay until whoever
    wrote the result says ``release`` (or leaves the ``with`` block).
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> Owner:
        self.begin = len(_OWNED)
        return self

    def release(self, keep: str | None = None) -> None:
        """Delete the tables made so far, but for ``keep``."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in [p for p in _OWNED[self.begin:] if p != keep]:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
            _OWNED.remove(path)

    def __exit__(self, *_) -> None:
        self.release()


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    The lineage ends here: a lost executor costs a re-read, not the work
    before, and a later join gets its own exchange, which adaptive execution
    can split when a key is hot.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else (
        spark.read.schema(_reordered(df, partition_by)).parquet(path))


def _reordered(df: DataFrame, last: tuple[str, ...]):
    from pyspark.sql.types import StructType

    fields = [f for f in df.schema.fields if f.name not in last]
    return StructType(fields + [df.schema[c] for c in last])


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def white_to_space(col):
    return F.regexp_replace(col, WHITE, " ")


def slices(batch, at: int, size_bytes: int):
    """An Arrow batch in runs of rows whose texts (column ``at``) have about ``size_bytes`` together."""
    import numpy as np
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    slot = np.cumsum(size) // size_bytes
    cut = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]).tolist() if len(slot) else []
    for s, e in zip(cut, [*cut[1:], batch.num_rows]):
        yield batch.slice(s, e - s)


def texts_of(column) -> list[str]:
    """The texts of an Arrow string column; null is empty, invalid UTF-8 reads as U+FFFD."""
    import pyarrow as pa

    return [x.decode("utf-8", "replace") if x else "" for x in column.view(pa.binary()).to_pylist()]


def sent(spark: SparkSession, thing):
    """A broadcast of an object's attributes (plain values and arrays).

    Unlike the object itself they can be read where this package is missing;
    ``received`` makes the object again, from the class that a task's function
    brings along by value.
    """
    return spark.sparkContext.broadcast(dict(vars(thing)))


def received(held, kind: type):
    out = kind.__new__(kind)
    vars(out).update(held.value)
    return out
