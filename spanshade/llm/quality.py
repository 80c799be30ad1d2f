"""Quality classifier: Bradley-Terry pairwise ranking.

Each document gets a score ``w . x``; the model says that document i is
preferred to j with probability sigmoid(w . (x_i - x_j)). The weights minimise
the logistic loss over preference pairs (a good and a bad labelled document),
that is, logistic regression on feature differences. The cut is a quantile of
the training scores: the one that separates the labels best. Scores are mapped
to 0..1 so that the cut falls on ``CUT``.

Features describe form, not words, so they hold for any language: the
frequencies of neighbouring character shapes (lower case, upper case, digit,
space, line end, each ASCII punctuation mark, other), and shares of repeated
words, long and short words, and lines. Whole texts are counted, in slices of
bounded size.

Training reads a bounded sample: labelled rows chosen by a hash of the id,
about ``per_label`` of each label (twice that at the very most, also where many
rows share an id); their ids (a bounded table) are broadcast to
fetch the texts, so no text shuffles. Scoring is one pass without a shuffle.

Defined results: a null or empty text is a document without characters and
gets the score of all-zero frequencies; invalid UTF-8 reads as U+FFFD; equal texts get equal scores; rows
without a label, or with a null one, never train; if one label is missing
every score is 1; other columns pass through, columns with the output names
are replaced.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import received, sent, slices, texts_of

CUT = 0.7
SLICE_BYTES = 8_000_000
MARKS = string.punctuation
LOWER, UPPER, DIGIT, SPACE, LINE, OTHER = range(6)
SHAPES = 6 + len(MARKS)
EXTRA = 8


def _shape_table() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x3000):
        s = chr(c)
        if s.islower():
            out[c] = LOWER
        elif s.isupper() or s.istitle():
            out[c] = UPPER
        elif s.isdigit():
            out[c] = DIGIT
        elif s == "\n":
            out[c] = LINE
        elif s.isspace():
            out[c] = SPACE
        elif s.isalpha():
            out[c] = LOWER
    out[0x3000:0xE000] = LOWER  # letters without case
    for i, m in enumerate(MARKS):
        out[ord(m)] = 6 + i
    return out


def features(texts: list[str], shape_of: np.ndarray) -> np.ndarray:
    """One row per text: shape-pair frequencies (square roots), then ``EXTRA`` shares."""
    size = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    shape = shape_of[points]
    out = np.zeros((len(texts), SHAPES * SHAPES + EXTRA), np.float32)
    end = np.cumsum(size)
    for i, (s, e) in enumerate(zip((end - size).tolist(), end.tolist())):
        if e - s < 2:
            continue
        x = shape[s:e].astype(np.int32)
        n = np.bincount(x[:-1] * SHAPES + x[1:], minlength=SHAPES * SHAPES)
        out[i, :-EXTRA] = np.sqrt(n / (e - s - 1))
        out[i, -EXTRA:] = _shares(texts[i])
    return out


def _shares(text: str) -> list[float]:
    words = text.split()
    lines = text.split("\n")
    n = max(1, len(words))
    pairs = len(set(zip(words, words[1:])))
    length = sum(map(len, words)) / n
    return [np.log1p(len(words)) / 10, len(set(words)) / n, pairs / max(1, len(words) - 1), length / 10,
            sum(w[:1].isupper() for w in words) / n, sum(w.isalpha() for w in words) / n,
            len(set(lines)) / len(lines), np.log1p(n / len(lines)) / 5]


class BradleyTerry:
    """Weights over standardised features, and the map of scores to 0..1."""

    def __init__(self, good: np.ndarray, bad: np.ndarray, rounds: int = 400, l2: float = 1e-3, seed: int = 5):
        self.shape_of = _shape_table()
        self.trained = len(good) > 0 and len(bad) > 0
        if not self.trained:
            return
        every = np.concatenate([good, bad])
        self.used = np.flatnonzero((every != 0).mean(axis=0) > 0.002)
        every = every[:, self.used]
        self.mean, self.std = every.mean(axis=0), every.std(axis=0) + 0.02
        good, bad = ((x[:, self.used] - self.mean) / self.std for x in (good, bad))
        rng = np.random.RandomState(seed)
        w = np.zeros(len(self.used))
        m = v = np.zeros_like(w)
        for t in range(1, rounds + 1):  # Adam on the logistic loss of drawn pairs
            diff = good[rng.randint(0, len(good), 512)] - bad[rng.randint(0, len(bad), 512)]
            p = 1 / (1 + np.exp(np.clip(diff @ w, -50, 50)))
            g = -(diff * p[:, None]).mean(axis=0) + l2 * w
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w = w - 0.02 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        self.w = w
        up, down = good @ w, bad @ w
        scores = np.concatenate([up, down])
        # balanced accuracy over quantiles of the scores; the middle of the best ones
        qs = np.linspace(0.001, 0.999, 999)
        cuts = np.quantile(scores, qs)
        gain = np.array([(up >= c).mean() + (down < c).mean() for c in cuts])
        best = np.flatnonzero(gain >= gain.max() - 1e-9)
        self.quantile = float(qs[best[len(best) // 2]])
        self.cut = (cuts[best[0]] + cuts[best[-1]]) / 2
        self.scale = max(1e-6, float(np.median(up) - np.median(down)) / 8)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.trained:
            return np.ones(len(texts))
        x = (features(texts, self.shape_of)[:, self.used] - self.mean) / self.std
        z = (x @ self.w - self.cut) / self.scale + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_label: int = 2500) -> BradleyTerry:
    """A model from the labelled rows where ``learnable`` (on the id) holds."""
    rows = labels.select(F.col(id_col), F.col(label_col).alias("label")).where(
        learnable & F.col("label").isin(0, 1) & F.col(id_col).isNotNull())
    n = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col("label") == 1, per_label / max(1, n.get(1, 0))).otherwise(per_label / max(1, n.get(0, 0)))
    chosen = rows.where(place < share).withColumnRenamed(id_col, "__id").distinct()
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "__id")
    shape_of = _shape_table()
    kind = "label int, id string, place long, x binary"

    def run(batches):
        for b in batches:
            x = features(texts_of(b.column(0)), shape_of)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), b.column(3), pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["label", "id", "place", "x"])

    # one row per id, label and text, then the first of each label: a bound also where rows share an id
    slim = sample.select("text", F.col("label").cast("int").alias("label"), F.col("__id").cast("string").alias("id"),
                         F.xxhash64("__id", "text").alias("place"))
    w = Window.partitionBy("label").orderBy("place", "id")
    got = slim.mapInArrow(run, kind).dropDuplicates(["label", "id", "place"]).withColumn(
        "rank", F.row_number().over(w)).where(F.col("rank") <= 2 * per_label).collect()
    got = sorted(got, key=lambda r: (r.id, r.label, r.x))  # so that training does not depend on task order
    of = lambda k: np.array([np.frombuffer(r.x, np.float32) for r in got if r.label == k], np.float64)
    return BradleyTerry(of(1), of(0))


def score(docs: DataFrame, model: BradleyTerry, text_col: str = "text", score_col: str = "score",
          keep_col: str = "predicted") -> DataFrame:
    """``docs`` with a score from 0 to 1 and 1 where it reaches ``CUT``."""
    docs = docs.select(*[c for c in docs.columns if c not in (score_col, keep_col)])
    held = sent(docs.sparkSession, model)
    at, names = docs.columns.index(text_col), [*docs.columns, score_col, keep_col]

    def run(batches):
        model = received(held, BradleyTerry)
        for whole in batches:
            for b in slices(whole, at, SLICE_BYTES):
                s = model.scores(texts_of(b.column(at)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= CUT).astype(np.int32))], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType()),
                                              T.StructField(keep_col, T.IntegerType())]))
