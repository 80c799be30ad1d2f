"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text recognises every substring of
it. A text is parsed against each automaton into longest matches: a phrase
runs as long as the automaton can follow, and the next starts at the letter
that broke it. The language that needs the fewest phrases wins, each count
normalised by the bits a phrase costs (the logarithm of the training length).

Letters are lower-cased and everything else is one space. Every letter of the
training text is a symbol of its own, of whatever script; a letter that no
excerpt has breaks every phrase. Texts are parsed whole, in windows of
``WINDOW`` letters (each starts a new phrase); all windows of all texts of a
slice advance together through the transitions: one gather per letter and
language for the ``DENSE`` most frequent symbols, a search in the sorted
transitions for the others.

Training reads a bounded sample: ``docs_per_lang`` labelled rows with a letter
per language at most (ranked by a hash of id and text, so rows that share an id
or have none are no exception), ``excerpt`` characters of each from a
place that the hash of the id gives (from its first letter on, if there is
none at that place), at most ``MAX_LETTERS`` over all languages; of more
languages than that allows (512) the most frequent are learned. So the tables, which are broadcast, have a
size that does not grow with the corpus. Prediction needs no shuffle and its
memory is one slice of texts.

Defined results: ``und`` with score 0 for a null text, a text without a
letter, or when no label was learned; invalid UTF-8 reads as U+FFFD; ties go to the smaller label; the score
is 1 minus the winner's phrase cost over the runner-up's (1 if there is only
one language); repeated rows get equal results; an empty table gives an empty
result; other columns pass through, columns with the output names are replaced.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import received, sent, slices, texts_of

WINDOW = 2048
SLICE_BYTES = 8_000_000
MAX_LETTERS = 262_144
SPACE, OTHER = 0, 1
#: Symbols with a column in the dense tables; it decides on speed and memory, not on results.
DENSE = 202


class SuffixAutomaton:
    """Recognises all substrings of the sequences added to it (online construction)."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def add(self, sequence) -> None:
        self.last = 0
        for c in sequence:
            self._extend(c)

    def _extend(self, c: int) -> None:
        nxt, link, length, p = self.next, self.link, self.length, self.last
        if c in nxt[p]:  # the longer prefix is known from another sequence
            q = nxt[p][c]
            self.last = q if length[q] == length[p] + 1 else self._split(p, q, c)
            return
        cur = len(nxt)
        nxt.append({}), link.append(0), length.append(length[p] + 1)
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, c)
        self.last = cur

    def _split(self, p: int, q: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1)
        link[q] = clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def rare(self, dense: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Transitions by classes from ``dense`` on: ``s * classes + c`` ascending, next states, and the root's by class."""
        found = sorted((s * classes + c, t) for s, row in enumerate(self.next) for c, t in row.items() if c >= dense)
        keys, to = np.array(found, np.int64).reshape(-1, 2).T
        root = np.full(classes, -1, np.int64)
        for c, t in self.next[0].items():
            root[c] = t
        return keys.copy(), to.astype(np.int32), root.astype(np.int32)

    def table(self, classes: int) -> np.ndarray:
        """For state s and class c below ``classes``, at ``s * classes + c``: next state * 4 + phrases that end."""
        step = np.full((len(self.next), classes), -1, np.int64)
        for s, row in enumerate(self.next):
            for c, t in row.items():
                if c < classes:
                    step[s, c] = t
        root = step[0].copy()
        dead = step < 0
        again = np.where(root >= 0, root * 4 + 1, 2)  # the breaking letter starts a phrase, or is one
        out = np.where(dead, again[None, :], step * 4)
        out[0] = np.where(root >= 0, root * 4, 1)
        return out.astype(np.int32)


class Model:
    """Letter classes, and per language a dense transition table and the transitions by rare letters."""

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        points = np.arange(sys.maxunicode + 1)
        lower = np.array([ord(l[0]) if len(l := chr(c).lower()) else c for c in points], np.int64)
        alpha = np.array([chr(c).isalpha() for c in points])
        text = "".join(t for ts in samples.values() for t in ts)
        seen = lower[self._points(text)]
        letters, n = np.unique(seen[alpha[seen]], return_counts=True)
        letters = letters[np.argsort(-n, kind="stable")]
        self.classes = len(letters) + 2
        self.dense = min(DENSE, self.classes)
        own = np.full(len(points), OTHER, np.min_scalar_type(self.classes))
        own[letters] = np.arange(len(letters)) + 2
        self.classes_of = np.where(alpha, own[lower], own.dtype.type(SPACE))
        tables, self.rare, self.cost = [], [], []
        for lang in self.langs:
            automaton, total = SuffixAutomaton(), 0
            for t in samples[lang]:
                codes, _ = self.codes([t])
                automaton.add(codes.tolist())
                total += len(codes)
            tables.append(automaton.table(self.dense).ravel())
            self.rare.append(automaton.rare(self.dense, self.classes))
            self.cost.append(np.log2(max(2, total)))
        self.base = np.cumsum([0, *map(len, tables)])[:-1] if tables else np.empty(0, int)
        self.table = np.concatenate(tables) if tables else np.empty(0, np.int32)

    @staticmethod
    def _points(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), np.uint32)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letter classes of all texts, runs of non-letters as one space, and the length of each text."""
        c = self.classes_of[self._points("".join(texts))]
        size = np.array([len(t) for t in texts], np.int64)
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != SPACE) | (c[:-1] != SPACE)
        begin = np.cumsum(size) - size
        keep[begin[size > 0]] = True
        through = np.r_[0, np.cumsum(keep)]
        return c[keep], through[begin + size] - through[begin]

    def _step_rare(self, k: int, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """What the dense table has, for rare classes."""
        keys, to, root = self.rare[k]
        if not len(keys):
            return np.where(state == 0, 1, 2)
        key = state.astype(np.int64) * self.classes + c
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        again = np.where(state == 0, 1, np.where(root[c] >= 0, root[c] * 4 + 1, 2))
        return np.where(keys[at] == key, to[at] * 4, again)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text (row) against each language, and whether it has a letter."""
        codes, size = self.codes(texts)
        begin = np.cumsum(size) - size
        windows = -(-size // WINDOW)
        text = np.repeat(np.arange(len(texts)), windows)
        within = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        start = begin[text] + within * WINDOW
        length = np.minimum(WINDOW, size[text] - within * WINDOW)
        order = np.argsort(-length, kind="stable")
        text, start, length = text[order], start[order], length[order]
        active = np.searchsorted(-length, -np.arange(WINDOW), "left")  # windows longer than t
        state = np.repeat(np.zeros((len(self.langs), 1), np.int32), len(text), axis=1)
        count = np.zeros(state.shape, np.int32)
        tables = [self.table[b:e] for b, e in zip(self.base, [*self.base[1:], len(self.table)])]
        for t in range(int(length.max(initial=0))):
            n = active[t]
            c = codes[start[:n] + t].astype(np.int32)
            rare = np.flatnonzero(c >= self.dense) if self.dense < self.classes else ()
            if len(rare):
                own = c[rare]
                c[rare] = OTHER
            for k, table in enumerate(tables):
                x = table[state[k, :n] * np.int32(self.dense) + c]
                if len(rare):
                    x[rare] = self._step_rare(k, state[k, rare], own)
                count[k, :n] += x & 3
                state[k, :n] = x >> 2
        count += state != 0  # the phrase that was open at the end
        total = np.zeros((len(texts), len(self.langs)), np.int64)
        np.add.at(total, text, count.T)
        letter = np.zeros(len(texts), bool)
        has = codes != SPACE
        through = np.r_[0, np.cumsum(has)]
        letter[:] = through[begin + size] > through[begin]
        return total, letter

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        total, letter = self.phrases(texts)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        cost = total * np.array(self.cost)
        best = cost.argmin(axis=1)
        low = np.sort(cost, axis=1)
        score = 1 - low[:, 0] / np.maximum(low[:, 1], 1e-9) if len(self.langs) > 1 else np.ones(len(texts))
        return ([self.langs[b] if ok else "und" for b, ok in zip(best, letter)],
                np.where(letter, np.clip(score, 0, 1), 0.0))


def train(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_lang: int = 64, excerpt: int = 512) -> Model:
    """A model from the rows where ``learnable`` holds and the label is not null."""
    text = F.col(text_col)
    rows = docs.where(learnable & F.col(lang_col).isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), text.alias("text"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    n = {r.lang: r.n for r in counts.limit(MAX_LETTERS // excerpt).collect()}
    if not n:
        return Model({})
    docs_per_lang = max(1, min(docs_per_lang, MAX_LETTERS // (excerpt * len(n))))
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    text = F.col("text")
    begin = F.pmod(F.xxhash64("id", F.lit("excerpt")), F.greatest(F.length(text) - excerpt + 1, F.lit(1))).cast("int") + 1
    piece = text.substr(begin, F.lit(excerpt))
    piece = F.when(piece.rlike(r"\p{L}"), piece).otherwise(F.regexp_replace(text, r"^\P{L}+", "").substr(1, excerpt))
    # about four times the rows needed, then the first of them: a bound also where many rows hash alike
    near = F.lit(False)
    for k, v in n.items():
        near = near | ((F.col("lang") == k) & (F.col("place") < min(1.0, 4.0 * docs_per_lang / v)))
    sample = rows.withColumn("place", place).where(near).select("lang", "id", "place", piece.alias("text"))
    w = Window.partitionBy("lang").orderBy("place", F.col("id").cast("string"), "text")
    sample = sample.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= docs_per_lang)
    out: dict[str, list[str]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r.lang, r.rank)):
        out.setdefault(r.lang, []).append(r.text)
    return Model(out)


def identify(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "lang_pred",
             score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score."""
    docs = docs.select(*[c for c in docs.columns if c not in (out_col, score_col)])
    held = sent(docs.sparkSession, model)
    at, names = docs.columns.index(text_col), [*docs.columns, out_col, score_col]

    def run(batches):
        model = received(held, Model)
        for whole in batches:
            for b in slices(whole, at, SLICE_BYTES):
                langs, score = model.predict(texts_of(b.column(at)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(score)], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.StringType()),
                                              T.StructField(score_col, T.DoubleType())]))
