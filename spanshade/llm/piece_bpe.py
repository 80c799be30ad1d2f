"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

A text is cut into words where no piece can reach across: before each run of
spaces. All words of a batch that are not in the task's bounded memo lie in
one flat array of symbols. Each round takes the best pair of every word (a
segmented minimum over pair ranks), merges it at its leftmost place in all
words at once, and closes the gaps; words without a pair leave the array.
Further places of the same pair in a word merge in the same round when no
piece built on the merged one ranks before it, so the order of merges cannot
matter; otherwise they wait for their own round. Pairs that all share the
model's lowest score (runs of spaces) are merged left to right in one sweep,
which is the order their ties demand.

Decoding maps ids to piece bytes with one gather per batch.

The model file is read on the driver (it has a fixed size) and its tables are
broadcast. There is no shuffle; memory per task is one Arrow batch plus the
memo of ``MEMO_WORDS`` words.

Defined results: a null or empty text has no ids and decodes to the empty
string; other columns pass through, and columns with the operator's output
names are replaced. Only models with the identity normaliser, byte fallback
and no user-defined pieces are supported; others raise ``ValueError``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import received, sent, slices

SPACE = "▁"
FAR = np.int64(1) << 40
MEMO_WORDS = 120_000
MEMO_CHARS = 64
WORDS = re.compile(" *[^ ]+| +")


class PieceTables:
    """Lookup tables of one model: pair ranks, merged pieces, piece bytes."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        types = [p.type for p in proto.pieces]
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or not trainer.byte_fallback or trainer.model_type != trainer.BPE or 4 in types or 5 in types):
            raise ValueError("only identity-normalised BPE models with byte fallback are supported")
        self.prefix = norm.add_dummy_prefix
        pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.cut = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.n = len(proto.pieces)
        # symbols: the pieces, then characters that are only parts of pieces; one more for all others
        symbols = dict(pieces)
        for c in sorted({c for p in pieces for c in p} - pieces.keys()):
            symbols[c] = self.n + len(symbols) - len(pieces)
        self.other = self.n + len(symbols) - len(pieces)
        self.size = self.other + 1
        self.symbol_of = np.full(0x110000, self.other, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        self.symbol_of[ord(" ")] = self.symbol_of[ord(SPACE)]
        scores = np.array([p.score for p in proto.pieces], np.float32)
        order = {s: r for r, s in enumerate(sorted({float(scores[i]) for i in pieces.values()}, reverse=True))}
        pairs = {}
        for p, i in pieces.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys], np.int64)
        self.rank = np.array([order[float(scores[i])] for i in self.merged], np.int64)
        self.last = int(self.rank.max(initial=0))
        # a merge may run at all its places at once if nothing built on it ranks as early
        soonest = np.full(self.size, FAR)
        np.minimum.at(soonest, self.keys // self.size, self.rank)
        np.minimum.at(soonest, self.keys % self.size, self.rank)
        self.at_once = soonest[self.merged] > self.rank
        # the lowest score: only pairs of that score may come of its merges
        self.sweep = bool((soonest[self.merged[self.rank == self.last]] >= self.last).all())
        self.byte_id = np.zeros(256, np.int64)
        raw = []
        for i, p in enumerate(proto.pieces):
            if p.type == 6:
                self.byte_id[int(p.piece[1:-1], 16)] = i
                raw.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == 2:
                raw.append(" ⁇ ".encode())
            elif p.type == 3:
                raw.append(b"")
            else:
                raw.append(p.piece.replace(SPACE, " ").encode())
        self.raw_len = np.array([len(r) for r in raw], np.int64)
        self.raw_at = np.r_[0, np.cumsum(self.raw_len)[:-1]]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def pair(self, a, b):
        """Index of each pair in the tables, or -1."""
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, -1) if len(self.keys) else np.full(len(a), -1)


def encode_words(m: PieceTables, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, flat, and the number of ids of each word."""
    lengths = np.array([len(w) for w in words], np.int64)
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sym = m.symbol_of[chars].astype(np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    start = np.arange(len(chars))
    pair = np.full(len(sym), -1, np.int64)
    inner = np.flatnonzero(word[1:] == word[:-1])
    pair[inner] = m.pair(sym[inner], sym[inner + 1])
    ranks = np.r_[m.rank, FAR]  # index -1: no pair
    done_sym, done_start, done_word = [], [], []
    while len(sym):
        rank = ranks[pair]
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.minimum.reduceat(rank, first)
        over = (best == FAR) | ((best == m.last) & m.sweep)
        span = np.diff(np.r_[first, len(sym)])
        if over.any():
            out = np.repeat(over, span)
            ties = best[over] == m.last
            s, t, w = sym[out], start[out], word[out]
            if ties.any():
                s, t, w = _sweep(m, s, t, w, np.repeat(ties, span[over]))
            done_sym.append(s), done_start.append(t), done_word.append(w)
            stay = ~out
            sym, start, word, pair, rank = sym[stay], start[stay], word[stay], pair[stay], rank[stay]
            best, span = best[~over], span[~over]
            if not len(sym):
                break
        own = np.repeat(np.arange(len(span)), span)
        hit = np.flatnonzero(rank == best[own])
        lead = np.r_[True, own[hit][1:] != own[hit][:-1]]
        chosen = pair[hit[lead]][np.cumsum(lead) - 1]
        ok = lead | ((pair[hit] == chosen) & m.at_once[chosen])
        hit = hit[ok]
        # overlapping places of one pair (aaa): every second one, from the left
        run = np.r_[True, hit[1:] != hit[:-1] + 1]
        at = np.arange(len(hit))
        hit = hit[(at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0]
        sym[hit] = m.merged[pair[hit]]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        moved = np.cumsum(keep) - 1
        hit = moved[hit]
        sym, start, word, pair = sym[keep], start[keep], word[keep], pair[keep]
        near = np.zeros(len(sym), bool)
        near[hit] = True
        near[hit[hit > 0] - 1] = True
        fresh = np.flatnonzero(near)
        pair[fresh] = -1
        fresh = fresh[fresh + 1 < len(sym)]
        fresh = fresh[word[fresh] == word[fresh + 1]]
        pair[fresh] = m.pair(sym[fresh], sym[fresh + 1])
    if not done_sym:
        return np.empty(0, np.int64), lengths
    sym, start, word = map(np.concatenate, (done_sym, done_start, done_word))
    order = np.argsort(start, kind="stable")
    sym, start, word = sym[order], start[order], word[order]
    return _with_bytes(m, sym, chars[start], word, len(words))


def _sweep(m, sym, start, word, tied):
    """Merge the lowest-scored pairs of the tied words from left to right."""
    keep_s, keep_t, keep_w = [], [], []
    known = {int(k): int(v) for k, v, r in zip(m.keys, m.merged, m.rank) if r == m.last}
    for s, t, w, tie in zip(sym.tolist(), start.tolist(), word.tolist(), tied.tolist()):
        keep_s.append(s), keep_t.append(t), keep_w.append(w)
        while tie and len(keep_s) > 1 and keep_w[-2] == w and (j := known.get(keep_s[-2] * m.size + keep_s[-1])) is not None:
            keep_s[-2:], keep_t[-1:], keep_w[-1:] = [j], [], []
    return np.array(keep_s, np.int64), np.array(keep_t, np.int64), np.array(keep_w, np.int64)


def _with_bytes(m, sym, char, word, n):
    """Symbols that are no piece become the bytes of their character."""
    odd = sym >= m.n
    if not odd.any():
        return sym, np.bincount(word, minlength=n)
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in char[odd].tolist()]
    size = np.ones(len(sym), np.int64)
    size[odd] = [len(r) for r in raw]
    out = np.repeat(sym, size)
    out[np.repeat(odd, size)] = m.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.bincount(np.repeat(word, size), minlength=n)


class Memo:
    """Ids of words seen before by this task, up to ``MEMO_WORDS`` of them."""

    def __init__(self, m: PieceTables):
        self.m = m
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {}
        self.flat, self.size = np.empty(0, np.int32), np.empty(0, np.int64)

    def words(self, text: str) -> list[str]:
        """The words of a text: those after one space without it, others after a mark."""
        if not text:
            return []
        s = text.replace(SPACE, " ")
        s = " " + s if self.m.prefix else s
        if not self.m.cut:
            return [SPACE + s]
        if s[0] == " " != s[-1] and "  " not in s:  # single spaces only: a plain split will do
            return s[1:].split(" ")
        return [w[1:] if w[0] == " " and w[1:2] not in ("", " ") else SPACE + w for w in WORDS.findall(s)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the number of ids of each."""
        lists = [self.words(t) for t in texts]
        if len(self.index) > MEMO_WORDS:
            self.clear()
        fresh = list(dict.fromkeys(w for ws in lists for w in ws if w not in self.index))
        known = len(self.size)
        long = [w for w in fresh if len(w) > MEMO_CHARS]
        if long:
            fresh = [w for w in fresh if len(w) <= MEMO_CHARS] + long
        if fresh:
            flat, size = encode_words(self.m, [w[1:] if w[0] == SPACE else " " + w for w in fresh])
            self.index.update(zip(fresh, range(known, known + len(fresh))))
            self.flat, self.size = np.concatenate([self.flat, flat.astype(np.int32)]), np.r_[self.size, size]
        index = self.index
        at = np.fromiter((index[w] for ws in lists for w in ws), np.int64)
        counts = [len(ws) for ws in lists]
        size, begin = self.size[at], (np.cumsum(self.size) - self.size)[at]
        ids = self.flat[_spans(begin, size)]
        per = np.add.reduceat(np.r_[size, 0], np.r_[0, np.cumsum(counts)[:-1]].astype(int)) if counts else np.empty(0, np.int64)
        per = np.where(np.array(counts) > 0, per, 0)
        if long:  # long words would fill the memo: forget them
            for w in long:
                del index[w]
            self.flat, self.size = self.flat[:int(self.size[:-len(long)].sum())], self.size[:-len(long)]
        return ids, per


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices ``begin[i] .. begin[i] + size[i] - 1``, one span after another."""
    total = int(size.sum())
    if not total:
        return np.empty(0, np.int64)
    return np.arange(total) + np.repeat(begin - (np.cumsum(size) - size), size)


#: Ids are turned into bytes in runs of this many.
RUN_IDS = 1 << 17


def decode_flat(m: PieceTables, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    ends = np.cumsum(counts)
    raw, cut, total = [], np.zeros(len(ends), np.int64), 0
    for s in range(0, len(ids), RUN_IDS):
        part = ids[s:s + RUN_IDS]
        size = m.raw_len[part]
        raw.append(m.raw[_spans(m.raw_at[part], size)].tobytes())
        own = slice(np.searchsorted(ends, s, "right"), np.searchsorted(ends, s + len(part), "right"))
        through = np.cumsum(size)
        cut[own] = total + through[ends[own] - s - 1]
        total += int(through[-1])
    raw = b"".join(raw)
    cut = np.maximum.accumulate(cut) if len(cut) else cut  # texts without ids end where the one before does
    out, at = [], 0
    for e in cut.tolist():
        t = raw[at:e]
        at = e
        out.append(t[1:] if m.prefix and t[:1] == b" " else t)
    return out


def load_tables(model_path: str) -> PieceTables:
    with open(model_path, "rb") as f:
        return PieceTables(f.read())


#: Texts are encoded in runs of rows of about this many bytes.
SLICE_BYTES = 1_000_000


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text (``array<int>``)."""
    docs = docs.select(*[c for c in docs.columns if c != ids_col])
    tables = sent(docs.sparkSession, load_tables(model_path))
    at, names = docs.columns.index(text_col), [*docs.columns, ids_col]

    def run(batches):
        memo = Memo(received(tables, PieceTables))
        for whole in batches:
            for b in slices(whole, at, SLICE_BYTES):
                ids, per = memo.encode([t or "" for t in b.column(at).to_pylist()])
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)].astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*b.columns, ids], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of each id list; a null list gives the empty string."""
    df = df.select(*[c for c in df.columns if c != out_col])
    tables = sent(df.sparkSession, load_tables(model_path))
    at, names = df.columns.index(ids_col), [*df.columns, out_col]

    def run(batches):
        m = received(tables, PieceTables)
        for b in batches:
            lists = b.column(at)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            texts = [t.decode("utf-8", "replace") for t in decode_flat(m, ids, counts)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType())]))


def round_trip(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids",
               out_col: str = "decoded") -> DataFrame:
    """``docs`` with the ids of each text and the text decoded from them.

    As ``encode`` and then ``decode``, in one pass: one Python worker per task
    instead of two, and the ids do not go through the JVM between them.
    """
    docs = docs.select(*[c for c in docs.columns if c not in (ids_col, out_col)])
    tables = sent(docs.sparkSession, load_tables(model_path))
    at, names = docs.columns.index(text_col), [*docs.columns, ids_col, out_col]

    def run(batches):
        m = received(tables, PieceTables)
        memo = Memo(m)
        for whole in batches:
            for b in slices(whole, at, SLICE_BYTES):
                ids, per = memo.encode([t or "" for t in b.column(at).to_pylist()])
                texts = [t.decode("utf-8", "replace") for t in decode_flat(m, ids, per)]
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)].astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*b.columns, ids, pa.array(texts, pa.string())], names)

    return docs.mapInArrow(run, T.StructType([
        *docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(out_col, T.StringType())]))


def id_digest(ids_col: str = "ids"):
    return F.sha2(F.concat_ws(",", F.col(ids_col).cast("array<string>")), 256)
