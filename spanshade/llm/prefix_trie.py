"""Prefix trie of conversations by time-forward processing.

A node of the trie is a distinct sequence of first turns; conversations that
start with it are its members. ``prefix_trie`` returns every node with its
parent, member and child counts, and totals over its subtree: childless nodes,
and the bytes that need not be kept or computed again when shared turns are
stored once.

Nodes. Turns are dealt by ranges of (conversation, place) and numbered and
hashed within a range; one row per range carries counts and hashes on to the
next, so a conversation of any length spreads over as many tasks as it needs.
The hash of a prefix is a wrapping sum, in two 64-bit lanes, of its turns'
digests mixed with their places: the hash of the parent is had by subtraction,
without a join. Equal hashes are one node, counted with partial sums, so a
start shared by a third of all conversations is one row after the map side.
Texts never shuffle, only their digests and lengths.

Totals. A node is named by its smallest member and its depth, so the nodes of
one member lie side by side. Ranges of these names are the shards. Time-forward
processing: within a shard nodes come in reverse level order (an external sort
by Spark), and each sends its total to its parent through a priority queue that
spills sorted runs; a node takes what was sent to it before it sends. A parent
in another shard gets what the shard holds for it through the shard roots: the
nodes whose parent is elsewhere, one per shard and such parent, themselves a
tree that is processed in the same way in one task. That task streams sorted
rows with a spilling queue, and there are far fewer shard roots than nodes. Their totals
then go back to the shards as messages and each shard runs once more.

The queue spills to the executor's own scratch folder (``SPARK_LOCAL_DIRS``),
as Spark's sorts do: an unlinked file of one task attempt, which no other reads.

Members that end at a node are hashed in numeric order; a node that ends so
many that they cross ranges is hashed from pieces, streamed in order.

Defined results: turns are ordered by ``turn`` (null first), then by the digest
of role and text, so repeated rows are turns of their own and the order of ties
does not depend on the input's; null roles and texts are empty; rows with a null
conversation take no part; an empty table has no nodes, not even a root;
columns other than the named ones are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Rows of a range at most (about), and the least worth a task of its own.
RANGE_ROWS, LEAST_ROWS = 1 << 19, 1 << 12
#: Messages that a queue holds in memory.
QUEUE_ROWS = 1 << 18
PIECE_BYTES = 1 << 13
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _parts(df: DataFrame, range_rows: int) -> int:
    rows = df.count()
    return max(1, -(-rows // range_rows), min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // LEAST_ROWS))


def _ranges(df: DataFrame, parts: int, *order: str) -> DataFrame:
    return df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())


def _whole(batches):
    """All rows of a task as numpy columns (a range is bounded), or None."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return None
    t = pa.Table.from_batches(held)
    return {n: b"".join(t[n].to_pylist()) if pa.types.is_binary(t.schema.field(n).type) else t[n].to_numpy() for n in t.column_names}


def _first_of_runs(*cols) -> np.ndarray:
    new = np.zeros(len(cols[0]), bool)
    new[0] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return new


def _within(new: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Running sums of ``x`` that begin again at every new run; 64-bit sums wrap."""
    through = np.cumsum(x)
    first = np.flatnonzero(new)
    return through - np.repeat(through[first] - x[first], np.diff(np.r_[first, len(x)]))


def _carried(ranges: DataFrame, sums: list[str]) -> tuple[dict, set]:
    """Per range what its first run has from the ranges before, and the ranges whose last run goes on.

    ``ranges`` has ``part, no, conv`` and running sums; one row per range comes to the driver.
    """
    last = F.max(F.struct("no", "conv", *sums)).alias("last")
    rows = ranges.groupBy("part").agg(F.min(F.struct("no", "conv")).alias("first"), last).orderBy("part").collect()
    carry, going_on, before, held = {}, set(), None, None
    for r in rows:
        own = [0] * len(sums)
        if before is not None and before.last.conv == r.first.conv:
            own = held
            carry[r.part] = (r.first.conv, own)
            going_on.add(before.part)
        whole = r.first.conv == r.last.conv
        held = [(r.last[s] + (o if whole else 0) + (1 << 63)) % (1 << 64) - (1 << 63) for s, o in zip(sums, own)]
        before = r
    return carry, going_on


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``(conv, place, digest, bytes)``: every turn with its place (from 1) in its conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = staged(conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.unhex(F.substring(F.sha2(said.cast("binary"), 256), 1, 32)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row")), "trie-turns")
    dealt = _ranges(turns, _parts(turns, range_rows), "conv", "turn", "digest", "row").select(
        "part", "conv", "digest", "bytes")

    def number(batches):
        x = _whole(batches)
        if x is not None:
            n = len(x["conv"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x["part"]), pa.array(np.arange(n)), pa.array(x["conv"]),
                 pa.array(_within(_first_of_runs(x["conv"]), np.ones(n, np.int64))),
                 pa.array([x["digest"][i:i + 16] for i in range(0, 16 * n, 16)], pa.binary()), pa.array(x["bytes"])],
                ["part", "no", "conv", "place", "digest", "bytes"])

    ranges = staged(dealt.mapInArrow(number, "part int, no long, conv long, place long, digest binary, bytes long"), "trie-places")
    carry, _ = _carried(ranges, ["place"])
    before = ranges.sparkSession.createDataFrame([(p, c, s[0]) for p, (c, s) in carry.items()], "part int, conv long, before long")
    return ranges.join(F.broadcast(before), ["part", "conv"], "left").select(  # one row per range at most
        "conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "bytes")


def _mixed(digest: bytes, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit lanes of each turn's digest and its place."""
    d = np.frombuffer(digest, np.uint64).reshape(-1, 2)
    out = []
    for k, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        x = d[:, k] + depth.astype(np.uint64) * np.uint64(odd)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out.append((x ^ (x >> np.uint64(32))).view(np.int64))
    return out[0], out[1]


def _paths(turns: DataFrame, range_rows: int) -> DataFrame:
    """``(conv, depth, hi, lo, up_hi, up_lo, bytes, ends)`` for each turn: the hash of the prefix and of the one before."""
    def hashed(batches):
        x = _whole(batches)
        if x is not None:
            new = _first_of_runs(x["conv"])
            hi, lo = _mixed(x["digest"], x["depth"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x["part"]), pa.array(np.arange(len(new))), pa.array(x["conv"]), pa.array(x["depth"]),
                 pa.array(_within(new, hi)), pa.array(_within(new, lo)), pa.array(hi), pa.array(lo), pa.array(x["bytes"]),
                 pa.array(np.r_[new[1:], True]), pa.array(np.arange(len(new)) == len(new) - 1)],
                ["part", "no", "conv", "depth", "hi", "lo", "own_hi", "own_lo", "bytes", "ends", "last"])

    dealt = _ranges(turns, _parts(turns, range_rows), "conv", "depth").select("part", "conv", "depth", "digest", "bytes")
    ranges = staged(dealt.mapInArrow(hashed, "part int, no long, conv long, depth long, hi long, lo long, own_hi long, "
                                     "own_lo long, bytes long, ends boolean, last boolean"), "trie-ranges")
    carry, going_on = _carried(ranges, ["hi", "lo"])
    known = ranges.sparkSession.sparkContext.broadcast((carry, going_on))

    def carried(batches):
        carry, going_on = known.value
        for b in batches:
            x = {n: b.column(n).to_numpy(zero_copy_only=False) for n in b.schema.names}
            hi, lo = x["hi"].copy(), x["lo"].copy()
            ends = x["ends"] & ~(x["last"] & np.isin(x["part"], list(going_on)))
            for p in np.unique(x["part"]).tolist():
                if p in carry:
                    conv, (more_hi, more_lo) = carry[p]
                    at = (x["part"] == p) & (x["conv"] == conv)
                    hi[at] += np.int64(more_hi)
                    lo[at] += np.int64(more_lo)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (x["conv"], x["depth"], hi, lo, hi - x["own_hi"], lo - x["own_lo"], x["bytes"], ends)],
                ["conv", "depth", "hi", "lo", "up_hi", "up_lo", "bytes", "ends"])

    return staged(ranges.mapInArrow(carried, "conv long, depth long, hi long, lo long, up_hi long, up_lo long, bytes long, "
                                    "ends boolean"), "trie-paths")


def prefix_trie(turns: DataFrame, conversations: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All nodes of the trie.

    ``turns`` has ``conv, depth, digest, bytes`` (depths 1, 2, ... without gaps
    in each conversation), ``conversations`` one row ``conv`` for each
    conversation, those without turns included.
    """
    root = conversations.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).first()
    paths = _paths(turns, range_rows)
    silent = conversations.select("conv").join(paths.where("depth = 1").select("conv"), "conv", "left_anti")
    ends = staged(paths.where("ends").select("conv", "depth", "hi", "lo").unionByName(
        silent.select("conv", *[F.lit(0).cast("long").alias(c) for c in ("depth", "hi", "lo")])), "trie-ends")
    nodes = staged(paths.groupBy("depth", "hi", "lo").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.min("up_hi").alias("up_hi"),
        F.min("up_lo").alias("up_lo"), F.min("bytes").alias("bytes"), F.sum(F.col("ends").cast("long")).alias("n_ends")),
        "trie-nodes")
    # the parent's smallest member: known for the root's children, one equi-join for all others
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"),
                      F.col("conv").alias("up"))
    named = nodes.where("depth > 1").join(up.hint("merge"), ["depth", "up_hi", "up_lo"]).unionByName(
        nodes.where("depth = 1").withColumn("up", F.lit(root.conv).cast("long")))
    named = named.select("conv", "depth", "up", "hi", "lo", "n", (F.col("n_ends") == F.col("n")).cast("long").alias("leaves"),
                         ((F.col("n") - 1) * F.col("bytes")).alias("saved"))
    top = conversations.sparkSession.createDataFrame(
        [(root.conv, 0, None, 0, 0, root.n, int(not turns.limit(1).count()), 0)] if root.n else [], named.schema)
    totals = subtree_totals(staged(named.unionByName(top), "trie-named"), range_rows)
    return totals.join(_end_hashes(ends, range_rows).hint("merge"), ["depth", "hi", "lo"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


# ---- totals over subtrees -------------------------------------------------

class SpillingQueue:
    """A priority queue of tuples of five integers, the smallest first.

    Above ``limit`` entries in memory the larger half goes to a file as a
    sorted run, which is read back in blocks when its turn comes.
    """

    BLOCK = 4096

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.runs, self.spills = max(2, limit), [], [], 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            self.heap.sort()
            keep = len(self.heap) // 2
            run = self._run(np.array(self.heap[keep:], np.int64))
            del self.heap[keep:]
            self.spills += 1
            heapq.heappush(self.runs, (next(run), self.spills, run))

    def _run(self, rows: np.ndarray):
        import tempfile

        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        with tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None) as f:
            f.write(rows.tobytes())
            n = len(rows)
            del rows
            for s in range(0, n, self.BLOCK):
                f.seek(s * 40)
                yield from map(tuple, np.frombuffer(f.read(self.BLOCK * 40), np.int64).reshape(-1, 5).tolist())

    def first(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            entry, no, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, no, run))
            return entry
        return heapq.heappop(self.heap)


def _rows(batches):
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batched(rows, names: list[str], size: int = 8192):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names)


NODE = ["conv", "depth", "up", "hi", "lo", "n", "leaves", "saved", "children"]
SHARD_NODE = ["shard", "kind", *NODE]


def _up_pass(inside, queue_rows: int):
    """Totals of nodes that come by shard in reverse level order; messages (kind 0) stand before their node."""
    def run(batches):
        def totals():
            shard, queue, sent = None, None, (0, 0, 0)
            for at, kind, conv, depth, up, hi, lo, n, leaves, saved, children in _rows(batches):
                if at != shard:
                    shard, queue, sent = at, SpillingQueue(queue_rows), (0, 0, 0)
                if kind == 0:
                    sent = sent[0] + leaves, sent[1] + saved, sent[2] + children
                    continue
                leaves, saved, children = leaves + sent[0], saved + sent[1], sent[2]
                sent = 0, 0, 0
                while (m := queue.first()) is not None and m[0] == -depth and m[1] == conv:
                    queue.pop()
                    leaves, saved, children = leaves + m[3], saved + m[4], children + 1
                if up is not None and inside(shard, up, depth - 1):
                    queue.push((1 - depth, up, 0, leaves, saved))
                yield conv, depth, up, hi, lo, n, leaves, saved, children
        yield from _batched(totals(), NODE)
    return run


def _long(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def subtree_totals(nodes: DataFrame, range_rows: int = RANGE_ROWS, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """``nodes`` with ``leaves`` and ``saved`` summed over subtrees, and ``children``.

    A node is ``(conv, depth)``, its parent ``(up, depth - 1)``.
    """
    nodes = nodes.select(*NODE[:-1], F.lit(0).cast("long").alias("children"))
    parts = _parts(nodes, range_rows)
    order = [F.col("shard"), F.col("depth").desc(), F.col("conv"), F.col("kind")]
    if parts == 1:
        alone = nodes.select(F.lit(0).cast("long").alias("shard"), F.lit(1).cast("long").alias("kind"), *NODE)
        return staged(alone.coalesce(1).sortWithinPartitions(*order).mapInArrow(
            _up_pass(lambda *_: True, queue_rows), _long(NODE)), "trie-totals")
    spark = nodes.sparkSession
    placed = staged(_ranges(nodes, parts, "conv", "depth").select(F.col("part").cast("long").alias("shard"), *NODE), "trie-shards")
    key = F.struct("conv", "depth")
    bounds = spark.sparkContext.broadcast({  # one row per shard
        r.shard: (tuple(r.a), tuple(r.b)) for r in placed.groupBy("shard").agg(F.min(key).alias("a"), F.max(key).alias("b")).collect()})

    def inside(shard, conv, depth):
        a, b = bounds.value[shard]
        return a <= (conv, depth) <= b

    roots = _shard_roots(placed, inside, parts)
    back = _across(roots, queue_rows)
    both = placed.select("shard", F.lit(1).cast("long").alias("kind"), *NODE).unionByName(back)
    return staged(both.repartition(parts, "shard").sortWithinPartitions(*order).mapInArrow(
        _up_pass(inside, queue_rows), _long(NODE)), "trie-totals")


def _shard_roots(placed: DataFrame, inside, parts: int) -> DataFrame:
    """One row per shard and parent elsewhere (``conv, depth``): sums over all nodes whose way up leaves the shard there,
    the number of nodes just below, and the parent's own shard and way up (``to_...``). The root's shard leaves at depth -1."""
    def ways(batches):
        def labels():
            shard, way = None, {}
            for at, conv, depth, up, leaves, saved in _rows(batches):
                if at != shard:
                    shard, way = at, {}
                out = (0, -1) if up is None else way[up, depth - 1] if inside(shard, up, depth - 1) else (up, depth - 1)
                way[conv, depth] = out
                yield at, conv, depth, *out, leaves, saved, int(out == (up, depth - 1))
        yield from _batched(labels(), names)

    names = ["shard", "conv", "depth", "out_conv", "out_depth", "leaves", "saved", "below"]
    marked = staged(placed.select("shard", "conv", "depth", "up", "leaves", "saved").repartition(parts, "shard")
                    .sortWithinPartitions("shard", "depth").mapInArrow(ways, _long(names)), "trie-ways")
    sums = marked.groupBy("shard", "out_conv", "out_depth").agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "below")])
    sums = sums.select("shard", F.col("out_conv").alias("conv"), F.col("out_depth").alias("depth"), "leaves", "saved", "below")
    to = marked.select("conv", "depth", F.col("shard").alias("to_shard"), F.col("out_conv").alias("to_conv"),
                       F.col("out_depth").alias("to_depth"))
    return staged(sums.join(to, ["conv", "depth"], "left"), "trie-roots")


def _across(roots: DataFrame, queue_rows: int) -> DataFrame:
    """The shard roots' totals, as messages (kind 0) to the nodes they hang on."""
    def run(batches):
        def totals():
            queue = SpillingQueue(queue_rows)
            for conv, depth, shard, leaves, saved, below, to_shard, to_conv, to_depth in _rows(batches):
                while (m := queue.first()) is not None and m[:3] == (-depth, conv, shard):
                    queue.pop()
                    leaves, saved = leaves + m[3], saved + m[4]
                if depth >= 0:
                    queue.push((-to_depth, to_conv, to_shard, leaves, saved))
                    yield to_shard, 0, conv, depth, None, 0, 0, 0, leaves, saved, below
        yield from _batched(totals(), SHARD_NODE)

    order = [F.col("depth").desc(), F.col("conv"), F.col("shard")]
    slim = roots.select("conv", "depth", "shard", "leaves", "saved", "below", "to_shard", "to_conv", "to_depth")
    return staged(slim.coalesce(1).sortWithinPartitions(*order).mapInArrow(run, _long(SHARD_NODE)), "trie-messages")


# ---- members that end at a node -------------------------------------------

def _end_hashes(ends: DataFrame, range_rows: int) -> DataFrame:
    """``(depth, hi, lo, sha)``: SHA-256 of the conversations that end at each node, ascending, comma-joined."""
    def hashed(batches):
        x = _whole(batches)
        if x is None:
            return
        new = np.flatnonzero(_first_of_runs(x["hi"], x["lo"], x["depth"]))
        stop = np.r_[new[1:], len(x["hi"])]
        out = []
        for s, e in zip(new.tolist(), stop.tolist()):
            text = ",".join(map(str, x["conv"][s:e].tolist())).encode()
            node = int(x["depth"][s]), int(x["hi"][s]), int(x["lo"][s])
            if 0 < s and e < len(x["hi"]):
                out.append((*node, hashlib.sha256(text).hexdigest(), 0, 0, None))
            else:  # the first or last of a range: it may go on in the next
                out += [(*node, None, int(x["part"][s]), k, text[k:k + PIECE_BYTES]) for k in range(0, len(text), PIECE_BYTES)]
        names = ["depth", "hi", "lo", "sha", "part", "at", "piece"]
        kinds = [pa.int64()] * 3 + [pa.string(), pa.int32(), pa.int64(), pa.binary()]
        for s in range(0, len(out), 8192):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[s:s + 8192]), kinds)], names)

    def joined(batches):
        def done():
            node, part, sha = None, None, None
            for depth, hi, lo, p, piece in _rows(batches):
                if (depth, hi, lo) != node:
                    if node is not None:
                        yield *node, sha.hexdigest()
                    node, sha = (depth, hi, lo), hashlib.sha256()
                elif p != part:
                    sha.update(b",")
                part = p
                sha.update(piece)
            if node is not None:
                yield *node, sha.hexdigest()
        rows = list(done())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["depth", "hi", "lo", "sha"])

    dealt = _ranges(ends, _parts(ends, range_rows), "hi", "lo", "depth", "conv").select("part", "conv", "depth", "hi", "lo")
    runs = staged(dealt.mapInArrow(hashed, "depth long, hi long, lo long, sha string, part int, at long, piece binary"), "trie-runs")
    open_ = runs.where("sha is null").select("depth", "hi", "lo", "part", "at", "piece").repartition(
        "hi", "lo", "depth").sortWithinPartitions("depth", "hi", "lo", "part", "at").drop("at")
    return staged(runs.where("sha is not null").select("depth", "hi", "lo", "sha").unionByName(
        open_.mapInArrow(joined, "depth long, hi long, lo long, sha string")), "trie-hashes")
