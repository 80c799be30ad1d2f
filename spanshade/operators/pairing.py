"""Positional pairing of two tables (a distributed zip).

Both sides get global ordinals: rows are dealt by ranges of the order columns
(or stay as they lie), each range counts its rows, and the counts before a
range are its offset. The sides then meet in one inner join on the ordinal,
which is a key without hot values. What one side has too many of is dropped.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Rows of a partition in ``monotonically_increasing_id``.
_STRIDE = 1 << 33


def with_ordinals(df: DataFrame, order_cols=None, out_col: str = "ordinal") -> DataFrame:
    """``df`` with consecutive numbers from 0 in the order of ``order_cols``
    (rows that tie there get some order; without columns: the table's own order).

    The numbered rows are written once, so the numbers stay the same when a
    task runs again. One row per range goes through the driver.
    """
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols or [])
    if cols:
        df = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    rows = materialize(df.withColumn("__id", F.monotonically_increasing_id()), "ordinals")
    part = F.floor(F.col("__id") / F.lit(_STRIDE)).cast("int")
    counts = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()
    before = dict(zip((r["__part"] for r in counts), accumulate((r["n"] for r in counts), initial=0)))
    offsets = df.sparkSession.createDataFrame(list(before.items()), "__part int, __before long")
    return rows.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn(
        out_col, F.col("__before") + F.col("__id") % F.lit(_STRIDE)).drop("__part", "__before", "__id")


def zip_rows(left: DataFrame, right: DataFrame, left_order=None, right_order=None) -> DataFrame:
    """The columns of both sides, row i of ``left`` beside row i of ``right``.

    The sides must not share column names.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"both sides have columns {sorted(shared)}")
    a = with_ordinals(left, left_order, "__ordinal")
    b = with_ordinals(right, right_order, "__ordinal")
    return a.join(b, "__ordinal").drop("__ordinal")
