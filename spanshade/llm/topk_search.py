"""Exact top-k search with multi-resolution segment statistics.

A vector is cut into segments, and each segment keeps its mean and deviation.
For a segment of width w the two give a bound on what it can add to an inner
product, ``w * (mean_q * mean_x + dev_q * dev_x)`` (Cauchy-Schwarz on the
centred parts); equivalently, the sum over segments of ``w * ((mean_q -
mean_x)^2 + (dev_q - dev_x)^2)`` is a lower bound of the squared distance. The
bounds are tried from coarse (few segments) to fine, each on what the one
before left over, against the k-th best exact score so far. Only survivors get
their exact score, so the result is exact whatever the bounds prune.

The queries go out in blocks of about ``query_block`` rows, dealt by hash, one
broadcast block at a time (its size does not depend on the data); candidates
are never shuffled or repeated, each task streams its own. A block starts
from thresholds over a bounded sample of candidates, which are true lower
bounds of the final k-th score. Inside a task the queries of a block go tile by
tile, so what it holds per pair is bounded by a tile and a chunk. A task returns at most k rows a query; the
final ranking is a window per query.

Exact scores are integers and are summed as 64-bit integers.

Defined results: vectors that are null, empty, or hold a null, NaN or infinite
component take no part; vectors of different lengths are never compared; rows
that repeat a query's id are one query (the smallest vector); a candidate row
with the query's id is its own and never returned; repeated candidate rows
each count; ties go to the smaller id; rows with a null id take no part; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

LEVELS = (4, 16, 32)
CHUNK = 2048
SAMPLE = 2048
#: Queries that meet a chunk of candidates at once.
TILE = 512


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


class Segments:
    """Means and deviations of rows, weighted so that bounds are plain matrix products."""

    def __init__(self, x: np.ndarray):
        self.levels = []
        d = x.shape[1]
        y = x.astype(np.float64)
        for k in LEVELS:
            if k >= d:
                break
            edge = np.arange(k) * d // k
            width = np.diff(np.r_[edge, d])
            mean = np.add.reduceat(y, edge, axis=1) / width
            var = np.add.reduceat(y * y, edge, axis=1) / width - mean * mean
            self.levels.append(np.concatenate([mean, np.sqrt(np.maximum(var, 0))], axis=1) * np.sqrt(np.r_[width, width]))
        self.norm = np.sqrt((y * y).sum(axis=1))

    def of(self, level: int, rows) -> np.ndarray:
        return self.levels[level][rows]


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.segments = Segments(vectors)
        self.score = [np.empty(0, np.int64)] * len(ids)
        self.vec = [np.empty(0, np.int64)] * len(ids)
        #: No final k-th score is below this.
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor.copy()

    def offer(self, vec_ids: np.ndarray, x: np.ndarray) -> None:
        own = Segments(x)
        for s in range(0, len(self.ids), TILE):
            self._offer(slice(s, s + TILE), vec_ids, x, own)

    def _offer(self, tile: slice, vec_ids: np.ndarray, x: np.ndarray, own: Segments) -> None:
        """One tile of queries against one chunk of candidates: the only arrays that hold a value per pair."""
        floor = self.floor[tile]
        kept = np.ones((len(floor), len(x)), bool)
        slack = 1e-9 * self.segments.norm[tile] * own.norm.max(initial=0) + 1e-6
        for level in range(len(self.segments.levels)):
            # queries and candidates with a pair left
            rows, cols = np.flatnonzero(kept.any(axis=1)), np.flatnonzero(kept.any(axis=0))
            at = np.ix_(rows, cols)
            bound = self.segments.of(level, rows + tile.start) @ own.of(level, cols).T
            kept[at] &= bound >= (floor - slack)[rows, None]
        for own_row in np.flatnonzero(kept.any(axis=1)):
            r = own_row + tile.start
            c = np.flatnonzero(kept[own_row])
            c = c[vec_ids[c] != self.ids[r]]
            score = x[c] @ self.vectors[r]
            good = score >= self.floor[r]
            score, ids = np.r_[self.score[r], score[good]], np.r_[self.vec[r], vec_ids[c[good]]]
            order = np.lexsort((ids, -score))[:self.k]
            self.score[r], self.vec[r] = score[order], ids[order]
            if len(order) == self.k:
                self.floor[r] = max(self.floor[r], score[order[-1]])


def _by_length(ids: np.ndarray, lists: pa.ListArray):
    """(ids, matrix) for each vector length in a batch."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    begin = np.cumsum(size) - size
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield int(d), ids[rows], flat[begin[rows][:, None] + np.arange(d)].astype(np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, query_block: int = 16_384) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` from two tables ``(id long, vec array<long>)``."""
    spark = vectors.sparkSession
    queries = staged(queries.where("id is not null").groupBy("id").agg(F.min("vec").alias("vec")), "topk-queries")
    vectors = vectors.where("id is not null").select("id", "vec")
    total = queries.count()
    blocks = max(1, -(-total // query_block))
    sample = vectors.limit(SAMPLE).toArrow()
    parts = []
    for i in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).toArrow()
        block = spark.sparkContext.broadcast(_starting(own, sample, k))
        parts.append(staged(_search(vectors, block, k), "topk-block"))
        block.destroy()  # the block's result is written
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _starting(queries: pa.Table, sample: pa.Table, k: int) -> dict:
    """Per vector length: query ids, their vectors, and starting thresholds."""
    out = {}
    pairs = lambda t: [x for b in t.combine_chunks().to_batches() for x in _by_length(b.column(0).to_numpy(), b.column(1))]
    seen = {d: (i, x) for d, i, x in pairs(sample)}
    for d, ids, q in pairs(queries):
        floor = np.full(len(ids), -np.inf)
        if d in seen and len(seen[d][0]) > k:
            best = Best(ids, q, k)
            best.offer(*seen[d])
            floor = best.floor
        out[d] = (ids, q, floor)
    return out


def _search(vectors: DataFrame, block, k: int) -> DataFrame:
    def run(batches):
        best = {d: Best(ids, q, k, floor) for d, (ids, q, floor) in block.value.items()}
        for b in batches:
            for d, ids, x in _by_length(b.column(0).to_numpy(), b.column(1)):
                if d in best:
                    for s in range(0, len(ids), CHUNK):
                        best[d].offer(ids[s:s + CHUNK], x[s:s + CHUNK])
        for t in best.values():
            n = [len(s) for s in t.score]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(t.ids, n), pa.int64()),
                pa.array(np.concatenate([*t.vec, np.empty(0, np.int64)]), pa.int64()),
                pa.array(np.concatenate([*t.score, np.empty(0, np.int64)]), pa.int64())], ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "query_id long, vec_id long, score long")
