"""Line dedup over exact reference counts, with sharded cuckoo filters in front.

State of a corpus (``LineState``, three tables in the shared folder):

* ``postings`` ``(key, doc)``: the documents that hold each line key;
* ``counts`` ``(key, refs, top)``: in how many documents, and the largest id;
* ``filters`` ``(shard, slots, stash)``: cuckoo filters over the keys that are
  in at least ``min_docs`` documents, one per hash shard.

``build`` makes the state, ``insert`` adds documents and ``delete`` takes
documents back: the counts move, and keys that cross the threshold enter or
leave their shard's filter (a cuckoo filter can delete). A key that finds no
slot goes to the shard's stash, so the filter never forgets one.

``apply_lines`` drops the lines. Documents with no line in the filters pass
straight on; only the others shuffle, to meet their exact drop lists, so false
alarms of the filter cost time and never a line. Filters are broadcast only up
to ``max_filter_bytes``; beyond that every document takes the exact join.

A line that stands in a third of all documents is one posting per document;
counts are summed before the shuffle, and the join on its key is split by
adaptive execution (both sides are written tables).

A key is the line without white space at both ends, A-Z in lower case; only
keys of at least ``min_chars`` code points count. It is held as a 128-bit hash.

Defined results: a null or empty text is one empty line; rows that share a
doc_id (null ids together) are one document when counting and keep or lose
lines alike; all occurrences in the largest doc_id stay; an empty table gives
an empty result; other columns pass through, and columns named ``n_lines`` or
``n_dropped`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import received, sent, staged

WHITE_BYTES = b" \t\n\x0b\x0c\r"
SLOTS = 4
KICKS = 200


@dataclass
class LineState:
    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int


# ---- keys -----------------------------------------------------------------

def line_key(line: bytes, min_chars: int) -> bytes | None:
    k = line.strip(WHITE_BYTES).lower()  # bytes.lower: A-Z only
    if len(k) < min_chars or (len(k) < 4 * min_chars and sum((b & 0xC0) != 0x80 for b in k) < min_chars):
        return None
    return xxhash.xxh3_128_digest(k)


def _postings(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    def keys(batches):
        for b in batches:
            out, owner = [], []
            for i, text in enumerate(b.column(1)):
                own = {line_key(x, min_chars) for x in (text.as_py() or b"").split(b"\n")}
                own.discard(None)
                out += own
                owner += [i] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()), b.column(0).take(pa.array(owner, pa.int64()))], ["key", "doc"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        keys, f"key binary, doc {kind}").distinct()


def _counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy("key").agg(F.count(F.lit(1)).alias("refs"), F.max("doc").alias("top"))


# ---- cuckoo filters -------------------------------------------------------

def _hash(key: bytes) -> int:
    return int.from_bytes(key[:8], "little")


def _places(h: int, buckets: int) -> tuple[int, int, int]:
    fp = (h >> 40 & 0xFFFF) or 1
    i = (h >> 16) & (buckets - 1)
    return fp, i, i ^ (fp * 0x5BD1E995 & (buckets - 1))


def cuckoo_insert(slots: np.ndarray, stash: set, h: int) -> None:
    """slots: buckets x SLOTS uint16, 0 is free."""
    buckets = len(slots)
    fp, i, j = _places(h, buckets)
    path = []
    at = i
    for kick in range(KICKS):
        for b in ((i, j) if kick == 0 else (at,)):
            free = np.flatnonzero(slots[b] == 0)
            if len(free):
                slots[b, free[0]] = fp
                return
        s = (h >> 8) + kick & (SLOTS - 1)
        path.append((at, s, int(slots[at, s])))
        slots[at, s], fp = fp, int(slots[at, s])
        at ^= fp * 0x5BD1E995 & (buckets - 1)
    for b, s, old in reversed(path):  # no place: put all back
        slots[b, s] = old
    stash.add(h)


def cuckoo_delete(slots: np.ndarray, stash: set, h: int) -> None:
    if h in stash:
        stash.discard(h)
        return
    fp, i, j = _places(h, len(slots))
    for b in (i, j):
        held = np.flatnonzero(slots[b] == fp)
        if len(held):
            slots[b, held[0]] = 0
            return


def _shard_of(key_col, shards: int):
    return F.expr(f"cast(conv(hex(substring({key_col}, 9, 3)), 16, 10) as int) % {shards}")


def _change_filters(filters: DataFrame | None, added: DataFrame, removed: DataFrame | None, shards: int) -> DataFrame:
    """New filters: ``removed`` keys leave, ``added`` keys enter."""
    schema = "shard int, slots binary, stash binary"

    def change(slots, stash, pdf):
        grow = int((pdf["sign"] > 0).sum())
        if slots is None:
            buckets = 1 << max(4, int(grow / SLOTS / 0.7).bit_length())
            slots, stash = np.zeros((buckets, SLOTS), np.uint16), set()
        for key in pdf.loc[pdf["sign"] < 0, "key"]:
            cuckoo_delete(slots, stash, _hash(key))
        for key in pdf.loc[pdf["sign"] > 0, "key"]:
            cuckoo_insert(slots, stash, _hash(key))
        return slots.tobytes(), np.array(sorted(stash), np.uint64).tobytes()

    keys = added.select("key", F.lit(1).alias("sign"))
    if removed is not None:
        keys = keys.unionByName(removed.select("key", F.lit(-1).alias("sign")))
    keys = keys.withColumn("shard", _shard_of("key", shards))
    if filters is None:
        def make(key, pdf):
            return pd.DataFrame([[key[0], *change(None, None, pdf)]], columns=["shard", "slots", "stash"])
        return keys.groupBy("shard").applyInPandas(make, schema)

    def update(key, old, pdf):
        slots = stash = None
        if len(old):
            slots = np.frombuffer(old["slots"][0], np.uint16).reshape(-1, SLOTS).copy()
            stash = set(np.frombuffer(old["stash"][0], np.uint64).tolist())
        return pd.DataFrame([[key[0], *change(slots, stash, pdf)]], columns=["shard", "slots", "stash"])
    return filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInPandas(update, schema)


class Probe:
    """All shards' filters as flat arrays; ``hits`` tests many keys at once."""

    def __init__(self, rows, shards: int):
        self.shards = shards
        self.start = np.zeros(shards, np.int64)
        self.buckets = np.ones(shards, np.int64)
        flat, stash, at = [np.zeros((1, SLOTS), np.uint16)], [], 1
        for r in rows:
            slots = np.frombuffer(r.slots, np.uint16).reshape(-1, SLOTS)
            self.start[r.shard], self.buckets[r.shard] = at, len(slots)
            flat.append(slots)
            at += len(slots)
            stash.append(np.frombuffer(r.stash, np.uint64))
        self.flat = np.concatenate(flat)
        self.stash = np.concatenate(stash) if stash else np.empty(0, np.uint64)

    def hits(self, keys: list[bytes]) -> np.ndarray:
        raw = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)
        h = raw[:, :8].copy().view(np.uint64)[:, 0]
        shard = (raw[:, 8].astype(np.int64) << 16 | raw[:, 9].astype(np.int64) << 8 | raw[:, 10]) % self.shards
        mask = self.buckets[shard] - 1
        fp = ((h >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.int64)
        fp[fp == 0] = 1
        i = (h >> np.uint64(16)).astype(np.int64) & mask
        j = i ^ (fp * 0x5BD1E995 & mask)
        at = self.start[shard]
        hit = (self.flat[at + i] == fp[:, None]).any(1) | (self.flat[at + j] == fp[:, None]).any(1)
        return hit | np.isin(h, self.stash) if len(self.stash) else hit


# ---- state ----------------------------------------------------------------

def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3,
          min_chars: int = 20) -> LineState:
    postings = staged(_postings(docs, id_col, text_col, min_chars), "line-postings")
    counts = staged(_counted(postings), "line-counts")
    common = counts.where(F.col("refs") >= min_docs)
    shards = max(64, 1 << (common.count() // 16384).bit_length())
    filters = staged(_change_filters(None, common, None, shards), "line-filters")
    return LineState(postings, counts, filters, shards, min_docs, min_chars)


def insert(state: LineState, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineState:
    """The state with more documents; a line already counted for an id counts once."""
    new, old = _postings(docs, id_col, text_col, state.min_chars), state.postings.toDF("__key", "__doc")
    new = new.join(old, (new["key"] == old["__key"]) & new["doc"].eqNullSafe(old["__doc"]), "left_anti")
    new = staged(new, "line-new")
    return _moved(state, state.postings.unionByName(new), new)


def delete(state: LineState, doc_ids: DataFrame) -> LineState:
    """The state as if the documents in ``doc_ids`` (one column) had never been inserted."""
    ids = doc_ids.toDF("__doc").distinct()
    of_them = state.postings["doc"].eqNullSafe(ids["__doc"])
    gone = staged(state.postings.join(ids, of_them, "left_semi").select("key", "doc"), "line-gone")
    left = state.postings.join(ids, of_them, "left_anti").select("key", "doc")
    return _moved(state, left, gone)


def _moved(state: LineState, postings: DataFrame, changed: DataFrame) -> LineState:
    postings = staged(postings, "line-postings")
    touched = changed.select("key").distinct()
    fresh = staged(_counted(postings.join(touched, "key", "left_semi")), "line-fresh")
    counts = staged(state.counts.join(touched, "key", "left_anti").select("key", "refs", "top")
                    .unionByName(fresh), "line-counts")
    before = touched.join(state.counts, "key").where(F.col("refs") >= state.min_docs).select("key")
    after = fresh.where(F.col("refs") >= state.min_docs).select("key")
    filters = staged(_change_filters(state.filters, after.join(before, "key", "left_anti"),
                                     before.join(after, "key", "left_anti"), state.shards), "line-filters")
    if filters.where(F.length("stash") * 4 > F.length("slots")).limit(1).count():  # over-full: make them anew
        filters = staged(_change_filters(None, counts.where(F.col("refs") >= state.min_docs), None, state.shards),
                         "line-filters")
    return LineState(postings, counts, filters, state.shards, state.min_docs, state.min_chars)


# ---- dropping -------------------------------------------------------------

def _probe(state: LineState, max_filter_bytes: int):
    """The broadcast filters, or None if they are above the bound."""
    size = state.filters.agg(F.sum(F.length("slots") + F.length("stash"))).first()[0] or 0
    if size > max_filter_bytes:
        return None
    return sent(state.filters.sparkSession, Probe(state.filters.toLocalIterator(), state.shards))


def drops(state: LineState, probe) -> DataFrame:
    """``(doc, keys)``: the line keys that each document loses."""
    hits = state.postings
    if probe is not None:
        def probed(batches):
            known = received(probe, Probe)
            for b in batches:
                if b.num_rows:
                    yield b.filter(pa.array(known.hits(b.column(0).to_pylist())))
        hits = hits.select("key", "doc").mapInArrow(probed, "key binary, doc " + dict(hits.dtypes)["doc"])
    common = state.counts.where(F.col("refs") >= state.min_docs).select("key", "top")
    lost = hits.join(common.hint("merge"), "key").where(~F.col("doc").eqNullSafe(F.col("top")))
    return staged(lost.groupBy("doc").agg(F.collect_list("key").alias("keys")), "line-drops")


def apply_lines(docs: DataFrame, state: LineState, id_col: str = "doc_id", text_col: str = "text",
                max_filter_bytes: int = 256 << 20) -> DataFrame:
    """``docs`` without the dropped lines, plus ``n_lines`` and ``n_dropped``."""
    probe = _probe(state, max_filter_bytes)
    lost = drops(state, probe)
    docs = docs.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")])
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType())])
    at, min_chars = docs.columns.index(text_col), state.min_chars
    raw = docs.withColumn(text_col, F.col(text_col).cast("binary"))

    def finished(b, texts, n_lines, n_dropped):
        cols = [b.column(i) for i in range(len(schema.fields) - 2)]
        cols[at] = pa.array(texts, pa.binary()).view(pa.string())
        return pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                                          [f.name for f in schema.fields])

    if probe is None:
        straight, meeting = None, raw
    else:
        def touched(b, known) -> np.ndarray:
            keys, owner = [], []
            for i, t in enumerate(b.column(at)):
                own = [k for x in (t.as_py() or b"").split(b"\n") if (k := line_key(x, min_chars))]
                keys += own
                owner += [i] * len(own)
            out = np.zeros(b.num_rows, bool)
            if keys:
                out[np.array(owner)[known.hits(keys)]] = True
            return out

        def clean(batches):
            known = received(probe, Probe)
            for b in batches:
                b = b.filter(pa.array(~touched(b, known)))
                texts = [t.as_py() or b"" for t in b.column(at)]
                yield finished(b, texts, [t.count(b"\n") + 1 for t in texts], [0] * len(texts))

        def dirty(batches):
            known = received(probe, Probe)
            for b in batches:
                yield b.filter(pa.array(touched(b, known)))

        straight = raw.mapInArrow(clean, schema)
        meeting = raw.mapInArrow(dirty, raw.schema)

    lost = lost.toDF("__doc", "__keys")
    met = meeting.join(lost.hint("merge"), meeting[id_col].eqNullSafe(lost["__doc"]), "left").drop("__doc")

    def rebuilt(batches):
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for t, gone in zip(b.column(at), b.column(b.num_columns - 1)):
                lines = (t.as_py() or b"").split(b"\n")
                gone = set(gone.as_py() or ())
                kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
                texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield finished(b, texts, n_lines, n_dropped)

    met = met.mapInArrow(rebuilt, schema)
    return met if straight is None else straight.unionByName(met)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3,
                min_chars: int = 20) -> DataFrame:
    return apply_lines(docs, build(docs, id_col, text_col, min_docs, min_chars), id_col, text_col)
