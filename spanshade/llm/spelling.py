"""Spelling variant grouping with asymmetric q-chunks.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. Of a near pair the longer word (either, if both are as long) is the
chunk side: it contributes two disjoint chunks, its halves. The other side
contributes its positional grams. One edit touches one chunk at most, so the
other stands unbroken in the shorter word, shifted by one place at most. A half
touches an end of its word and the edit leaves that end where it is, so the
length difference tells the shift: of the grams within shift one only the one
at that place can join, and no other is made. Chunks and grams meet in an
equi-join on (length, place, hash of the chunk); met pairs are verified by their
edit distance.

A bucket in which many words share a chunk is not paired. Its rows are chunked
again: the part in which the edit must lie is halved, so each chunk grows by
half of the rest, until buckets are small or the part is one code point. Then
every pair in a bucket is a near pair, and a bucket has no more words than there
are letters for one place (squared, for none). So no round makes more than
``bucket_pairs`` pairs a row, none is left out, and a word costs at most two
rows a code point and side in the deepest round. Rounds: the logarithm of the
longest word in a crowded bucket. Everything is DataFrame work, in written tables.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is at least ``ratio`` times the word's; the root follows
forms to the last. Counts grow along forms, so there are no cycles, and the
chain of a word is no longer than the logarithm of the largest count; it is
followed by doubling.

Defined results: a null or empty text has no words; each occurrence counts, in
repeated rows too; null words and words without near words have neither form
nor near words (null words are dropped); an empty table gives an empty result;
columns other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Fixed value: the letters of a word.
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKET = ["size", "a", "b", "key"]


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7) -> DataFrame:
    """``(id, word)``: each maximal run of letters of at least ``min_chars`` code points, A-Z in lower case."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{min_chars},}}"), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("word")).withColumn(
        "word", F.translate("word", UPPER, LOWER))


def count_words(words: DataFrame, min_chars: int = 7, min_count: int = 2) -> DataFrame:
    """``(word, n)`` of the words (column ``word``) that are long and frequent enough."""
    return words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= min_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the hash of all that lies outside of the open part ``a`` to ``b`` (places in the chunk side's word)."""
    behind = F.col("b") + F.length("word") - F.col("size") + 1
    return rows.withColumn("key", F.xxhash64(F.substring("word", F.lit(1), F.col("a")),
                                             F.substring("word", behind, F.length("word"))))


def _halves(rows: DataFrame) -> DataFrame:
    """Every row twice: the open part is its first half, or its second."""
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    parts = F.array(F.struct(F.col("a").alias("x"), mid.alias("y")), F.struct(mid.alias("x"), F.col("b").alias("y")))
    return rows.withColumn("part", F.explode(parts)).select(
        "word", "n", "gram", "size", F.col("part.x").alias("a"), F.col("part.y").alias("b"))


def near_pairs(vocabulary: DataFrame, bucket_pairs: int = 32) -> DataFrame:
    """``(word, n, other, other_n)``, each near pair of ``(word, n)`` rows once."""
    size = F.length("word")
    chunks = vocabulary.select("word", "n", F.lit(False).alias("gram"), size.alias("size"))
    grams = vocabulary.select("word", "n", F.lit(True).alias("gram"), F.explode(F.array(size, size + 1)).alias("size"))
    rows = chunks.unionByName(grams).select("*", F.lit(0).alias("a"), F.col("size").alias("b"))
    found = []
    while True:
        rows = staged(_keyed(_halves(rows)), "spelling-rows")
        c, g = F.sum(F.when(F.col("gram"), 0).otherwise(1)), F.sum(F.when(F.col("gram"), 1).otherwise(0))
        # a chunk meets its own word's gram: a bucket with one gram holds no pair
        sizes = rows.groupBy(*BUCKET).agg(c.alias("c"), g.alias("g")).where("c > 0 and g > 1")
        crowded = (F.col("c") * F.col("g") > bucket_pairs * (F.col("c") + F.col("g"))) & (F.col("b") - F.col("a") > 1)
        sizes = staged(sizes.select(*BUCKET, crowded.alias("crowded")), "spelling-buckets")
        rows = staged(rows.join(sizes.hint("merge"), BUCKET), "spelling-met", "crowded")
        few = rows.where("not crowded")
        left = few.where("not gram").select(*BUCKET, "word", "n")
        right = few.where("gram").select(*BUCKET, F.col("word").alias("other"), F.col("n").alias("other_n"))
        once = (F.length("other") < F.col("size")) | (F.col("other") < F.col("word"))
        found.append(staged(left.join(right.hint("merge"), BUCKET).where(
            once & (F.levenshtein("word", "other", 1) == 1)).select("word", "n", "other", "other_n"), "spelling-pairs"))
        rows = rows.where("crowded").select("word", "n", "gram", "size", "a", "b")
        if not rows.limit(1).count():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()  # an edit between equal letters is found in both halves


def group_variants(vocabulary: DataFrame, ratio: int = 10, bucket_pairs: int = 32) -> DataFrame:
    """One row per ``(word, n)``: ``word, form, root, n, n_near, form_n``."""
    vocabulary = staged(vocabulary.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")),
                        "spelling-words")
    pairs = near_pairs(vocabulary, bucket_pairs)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    near = staged(best.select("word", "n_near", F.when(frequent, F.col("best.other")).alias("form"),
                              F.when(frequent, -F.col("best.less")).alias("form_n")), "spelling-near")
    roots = _roots(near.where(F.col("form").isNotNull()).select("word", "form"))
    return vocabulary.join(near.hint("merge"), "word", "left").join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the last word that is reached from each by following forms."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        up = at.select(F.col("word").alias("root"), F.col("root").alias("up"))
        at = staged(at.join(up.hint("merge"), "root", "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "spelling-roots")
        if not at.where("moved").limit(1).count():
            return at.select("word", "root")


def without_point(word: Column, place: Column) -> Column:
    """``word`` without its code point at ``place`` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))
