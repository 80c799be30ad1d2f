"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints: each document's bits are the majority over the XXH64 hashes of
its word shingles. Equal fingerprints collapse first, with partial sums, so a
group of copies that holds a third of all rows becomes one row.

Links: for radius r every bit position gets a vector of r + 1 bits, and every
non-zero vector v gives one table whose mask keeps the positions with odd
inner product with v. Two fingerprints that differ in at most r positions have
at most r such vectors; some v is orthogonal to all of them, and in that
table the two agree. So 2^(r+1) - 1 tables (31 for r = 4) miss no pair. About
half of the 64 bits stay in each mask, so chance collisions are rare.

A bucket is searched as a graph: from a fingerprint outwards, taking found
ones out of the rest, and only a spanning forest of its links is returned,
never its pairs. In a dense bucket the first few searches reach everything.
Buckets above ``block`` fingerprints are cut into blocks, and each pair of
blocks is a task of its own, so no task holds more than two blocks and no
pair is lost. Buckets of one are dropped before that by a count.

Components: minimum labels spread along links and through the labels
themselves until nothing changes; every round is a written table, joined on
keys of written tables so adaptive execution can split hubs.

Defined results: a null or blank text has fingerprint 0; texts shorter than a
shingle are one shingle of all their words; a repeated doc_id is a row of its
own; a null id never is a ``component_id`` unless its group has no other; an
empty table gives an empty result; other columns pass through, and columns
named ``fingerprint`` or ``component_id`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

SEED = 42
#: Shingles per slice when counting bits, so a very long text needs bounded memory.
SLICE = 1 << 16


def fingerprint(text: bytes | None, words: int) -> int:
    parts = (text or b"").lower().split()  # bytes: A-Z only, and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    begin = np.cumsum(size + 1) - size - 1
    n = max(1, len(parts) - words + 1)
    end = (begin + size)[min(words, len(parts)) - 1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for s in range(0, n, SLICE):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(begin[s:min(n, s + SLICE)].tolist(), end[s:s + SLICE].tolist())], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """``(id, fp)``, fp as a signed 64-bit integer."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, fp long")


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """Masks of the 2^(radius+1) - 1 tables, as unsigned 64-bit integers."""
    own = np.random.RandomState(seed).randint(0, 1 << (radius + 1), 64)
    return [sum(1 << i for i in range(64) if bin(int(own[i]) & v).count("1") % 2) for v in range(1, 1 << (radius + 1))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = 4, block: int = 2048) -> DataFrame:
    """``(a, b)``: links that connect all fingerprints at most ``radius`` bits apart.

    ``fps``: one column ``fp``, without repeats.
    """
    masks = [_signed(m) for m in covering_masks(radius)]
    keys = F.transform(F.array(*[F.lit(m).cast("long") for m in masks]),
                       lambda m, i: F.struct(i.cast("int").alias("t"), F.col("fp").bitwiseAND(m).alias("key")))
    rows = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    full = staged(rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
    rows = rows.join(full.hint("merge"), ["t", "key"])
    # large buckets: every pair of blocks meets in a cell of its own
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("long")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    rows = rows.withColumn("blocks", blocks).withColumn("own", own)
    cell = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.struct(
        F.least(F.col("own"), j).alias("x"), F.greatest(F.col("own"), j).alias("y"))))
    rows = rows.select("t", "key", "fp", cell.alias("c")).select("t", "key", "c.x", "c.y", "fp")
    cells = rows.repartition("t", "key", "x", "y").sortWithinPartitions("t", "key", "x", "y")

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            cols = np.stack([t.column(i).to_numpy().astype(np.int64) for i in range(5)])
            held = cols if held is None else np.concatenate([held, cols], axis=1)
            cut = np.flatnonzero((held[:4, 1:] != held[:4, :-1]).any(axis=0)) + 1
            if len(cut):  # all cells but the last are whole
                yield _forest(held[:, :cut[-1]], cut[:-1], radius)
                held = held[:, cut[-1]:]
        if held is not None and held.shape[1]:
            yield _forest(held, np.empty(0, int), radius)

    return cells.mapInArrow(run, "a long, b long").distinct()


def _forest(cols: np.ndarray, cut: np.ndarray, radius: int) -> pa.RecordBatch:
    a, b = [], []
    fp = cols[4].view(np.uint64) if cols[4].flags.c_contiguous else cols[4].copy().view(np.uint64)
    for s, e in zip(np.r_[0, cut].astype(int), np.r_[cut, cols.shape[1]].astype(int)):
        rest = fp[s:e]
        if len(rest) == 2:
            if int(rest[0] ^ rest[1]).bit_count() <= radius:
                a.append(rest[:1]), b.append(rest[1:])
            continue
        while len(rest) > 1:
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                x = front.pop()
                near = np.bitwise_count(rest ^ x) <= radius
                if near.any():
                    found = rest[near]
                    a.append(np.full(len(found), x)), b.append(found)
                    front.extend(found)
                    rest = rest[~near]
    join = lambda xs: pa.array((np.concatenate(xs) if xs else np.empty(0, np.uint64)).view(np.int64), pa.int64())
    return pa.RecordBatch.from_arrays([join(a), join(b)], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with an edge; the root is the smallest node.

    Each round hooks every label to the smallest label across an edge, then
    follows labels twice, so chains shorten by doubling.
    """
    both = staged(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        edges.select(F.col("b"), F.col("a"))).where("node <> other").distinct(), "cc-edges")
    labels = staged(both.groupBy("node").agg(F.min("other").alias("o")).select(
        "node", F.least("node", "o").alias("root")), "cc-labels")
    while True:
        other = labels.select(F.col("node").alias("other"), F.col("root").alias("near"))
        seen = both.join(other.hint("merge"), "other").groupBy("node").agg(F.min("near").alias("near"))
        seen = staged(labels.join(seen, "node").select("node", "root", F.least("root", "near").alias("low")), "cc-seen")
        # the smallest label next to any member pulls the whole label over
        pull = seen.groupBy("root").agg(F.min("low").alias("to"))
        moved = staged(seen.select("node", "root").join(staged(pull, "cc-pull").hint("merge"), "root").select(
            "node", F.col("root").alias("was"), F.col("to").alias("root")), "cc-moved")
        changed = moved.where("root < was").limit(1).count()
        labels = moved.select("node", "root")
        if not changed:
            return labels
        for _ in range(2):
            up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
            labels = staged(labels.join(up.hint("merge"), "root").select("node", F.col("up").alias("root")), "cc-labels")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                max_bits: int = 4) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable)."""
    prints = staged(fingerprints(docs, id_col, text_col, words), "simhash-prints")
    groups = group_ids(prints, max_bits)
    return prints.join(groups.hint("merge"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
             max_bits: int = 4) -> DataFrame:
    """One row of each group, the one with the smallest id; all columns of ``docs``.

    Rows are told apart by a number given when they are written, so rows that
    repeat a doc_id are dropped too.
    """
    rows = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "simhash-rows")
    prints = staged(fingerprints(rows, "__row", text_col, words), "simhash-prints")
    groups = group_ids(prints, max_bits)
    # the first of a component is the smallest doc_id (nulls last), then the smallest row number
    ids = rows.select("__row", F.col(id_col).alias("doc"))
    member = prints.join(groups.hint("merge"), "fp").select(F.col("id").alias("__row"), "component_id")
    first = member.join(ids.hint("merge"), "__row").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc").isNull().alias("n"), "doc", "__row")).alias("first"))
    kept = staged(first.select(F.col("first.__row").alias("__row")), "simhash-kept")
    return rows.join(kept.hint("merge"), "__row", "left_semi").select(*docs.columns)


def group_ids(prints: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, component_id)`` for every fingerprint of ``(id, fp)``."""
    least = staged(prints.groupBy("fp").agg(F.min("id").alias("id")), "simhash-distinct")
    edges = staged(links(least.select("fp"), max_bits), "simhash-links")
    labels = components(edges)
    rooted = least.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root"))
    rooted = staged(rooted, "simhash-rooted")
    own = staged(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "simhash-components")
    return staged(rooted.join(own.hint("merge"), "root").select("fp", "component_id"), "simhash-groups")
