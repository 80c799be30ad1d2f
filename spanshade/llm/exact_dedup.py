"""Exact dedup by two Bloom passes.

Pass one marks, in a two-bit saturating Bloom filter, every position hit by
the hashes of the normalised texts: once or more than once. Pass two tests
each row against the "more than once" bits. A hash that occurs twice has all
its positions hit twice, so no repeat is missed; a row that fails the test is
certainly alone and goes straight to the output. Only the rows that pass
(repeats, and a few per cent of false alarms) shuffle, on the exact SHA-256.

Texts themselves never shuffle: everything after the first scan works on
``(doc_id, sha)``. A filter is built and broadcast for one hash range at a
time, so its size is bounded by ``max_filter_bytes`` whatever the input; the
number of ranges grows with the row count instead. Each task sends the
positions it hit without repeats, so a text copied a million times costs one
position per task. A group that holds a third of all rows is counted with
partial sums, and the join that returns its rows is split by adaptive
execution (the group table is written first, so the join has exchanges of its
own on both sides).

Defined results: a null text counts as empty; the empty text is a text like
any other; rows that repeat a doc_id are rows of their own (all with the
smallest doc_id of their group are kept); a null doc_id never becomes
``keep_id`` unless the group has no other, and such a row is kept only if it
is alone; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_or_empty, white_to_space

BLOCK_BITS = 1 << 14
BITS_PER_ROW = 16
PROBES = 2
#: Hashes that a task holds before it sorts their positions.
HELD_ROWS = 1 << 20


def normalised(col):
    return white_to_space(col)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_filter_bytes: int = 128 << 20) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    sha = F.unhex(F.sha2(normalised(text_or_empty(text_col)), 256))
    hashes = staged(docs.select(F.col(id_col).alias("id"), sha.alias("sha"))
                    .withColumn("h", F.xxhash64("sha")), "exact-hashes")
    tested = _tested(hashes, max_filter_bytes)
    alone = tested.where("not again").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    again = tested.where("again").select("id", "sha")
    groups = staged(again.groupBy("sha").agg(F.min("id").alias("keep_id"),
                                             F.count(F.lit(1)).alias("group_size")), "exact-groups")
    back = again.join(groups.hint("merge"), "sha").select(
        "id", "keep_id", "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.col("group_size") == 1).alias("kept"), "sha")
    return alone.unionByName(back).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"))


def _tested(hashes: DataFrame, max_filter_bytes: int) -> DataFrame:
    """``hashes`` with ``again``: false only where the hash occurs once."""
    spark = hashes.sparkSession
    rows = hashes.count()
    ranges = max(1, -(-rows * BITS_PER_ROW // (max_filter_bytes * 8)))
    blocks = max(1, -(-rows * BITS_PER_ROW // (ranges * BLOCK_BITS)))
    parts = []
    if ranges > 1:  # written by range: each then reads its own folder and no other
        kinds = hashes.dtypes
        dealt = hashes.withColumn("range", F.pmod(F.shiftright("h", 40), F.lit(ranges)).cast("int"))
        hashes = staged(dealt.repartition("range", F.pmod("h", F.lit(8))), "exact-ranges", "range")
        assert [k for k in hashes.dtypes if k[0] != "range"] == kinds
    for r in range(ranges):
        own = hashes.where(F.col("range") == r).drop("range") if ranges > 1 else hashes
        filt = repeated_filter(own.select("h"), blocks)
        bits = spark.sparkContext.broadcast(filt)
        parts.append(staged(own.mapInArrow(_tester(bits), "id long, sha binary, again boolean")
                            if dict(hashes.dtypes)["id"] == "bigint" else
                            own.mapInArrow(_tester(bits), f"id {dict(hashes.dtypes)['id']}, sha binary, again boolean"),
                            "exact-tested", "again"))
        bits.unpersist()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def positions(h: np.ndarray, blocks: int) -> np.ndarray:
    """Bit positions of each hash: a block, and ``PROBES`` places inside it."""
    u = h.view(np.uint64)
    block = (u % np.uint64(blocks)).astype(np.int64)
    mixed = (u * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    width = np.uint64(BLOCK_BITS.bit_length() - 1)
    return np.stack([block * BLOCK_BITS + ((mixed >> (width * np.uint64(k))) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
                     for k in range(PROBES)])


def repeated_filter(hashes: DataFrame, blocks: int) -> np.ndarray:
    """The "hit more than once" bits, as a packed array of ``blocks * BLOCK_BITS`` bits."""
    def hit(batches):
        once = twice = np.empty(0, np.int64)
        held, rows = [], 0

        def merged():  # all positions held so far at once, not batch by batch
            p = positions(np.concatenate(held), blocks)
            p[1, p[1] == p[0]] = -1  # the probes of one hash may coincide: within a hash they count once
            u, n = np.unique(p, return_counts=True)
            u, n = u[u >= 0], n[u >= 0]
            return np.union1d(once, u), np.union1d(twice, np.concatenate([u[n > 1], np.intersect1d(u, once)]))

        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False))
            rows += b.num_rows
            if rows >= HELD_ROWS:
                once, twice = merged()
                held, rows = [], 0
        if held:
            once, twice = merged()
        block = once // BLOCK_BITS
        again = np.isin(once, twice)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(once) else np.empty(0, int)
        ends = np.r_[starts[1:], len(once)]
        yield _pa_batch(block[starts], [
            ((once[s:e] % BLOCK_BITS) * 2 + again[s:e]).astype(np.uint16).tobytes() for s, e in zip(starts, ends)])

    def merge(key, pdf):
        seen = np.zeros(BLOCK_BITS, np.int8)
        for raw in pdf["hits"]:
            p = np.frombuffer(raw, np.uint16)
            seen[p >> 1] = np.minimum(2, seen[p >> 1] + 1 + (p & 1))
        return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(seen > 1).tobytes()]})

    out = np.zeros(blocks * BLOCK_BITS // 8, np.uint8)
    merged = hashes.mapInArrow(hit, "block long, hits binary").groupBy("block").applyInPandas(
        merge, "block long, bits binary")
    for row in merged.toLocalIterator():
        out[row.block * BLOCK_BITS // 8:(row.block + 1) * BLOCK_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return out


def _pa_batch(block, hits):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(hits, pa.binary())], ["block", "hits"])


def _tester(bits):
    def test(batches):
        import pyarrow as pa

        filt = bits.value
        blocks = len(filt) * 8 // BLOCK_BITS
        for b in batches:
            p = positions(b.column(2).to_numpy(zero_copy_only=False), blocks)
            again = ((filt[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1).all(axis=0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(again)], ["id", "sha", "again"])
    return test
