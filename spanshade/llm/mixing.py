"""Mix sources to target weights by nested hash-threshold histograms.

Every document has a fixed place in its source: a 60-bit hash of its id. A
budget becomes a threshold on that hash, so a smaller budget always takes a
subset of a larger one and reruns agree. The threshold is found without
sorting the documents:

1. sum the words by (source, top 12 bits of the hash) and find, per source,
   the bucket in which the running sum meets the budget;
2. sum only that bucket's documents by the next 12 bits, and again find the
   bucket where the budget is met;
3. place the threshold between the few documents of that last bucket.

Then one filter on ``hash <= threshold`` makes the mix. Levels 1 and 2 are
partial sums before any shuffle, so a source with a third of all rows moves no
more rows than another; level 3 sees about one document in 2^24 of a source.
Texts never shuffle: the plan after the first scan works on ids and sizes.

Targets: all words times ``share``, dealt by weight; a target above
``max_epochs`` times its source's words stops there and the excess goes to the
others by weight (water filling over the source table, one row per source).
A source takes every document ``floor(target / words)`` times and those under
the threshold once more.

Of the two thresholds around the budget the nearer one wins (the lower on a
tie). Documents with one hash (repeated ids) are taken or left together.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a null id hashes like the empty string; a source without words
has target 0 and takes nothing; an empty table gives an empty result; other
columns pass through, and columns named like the operator's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged, text_or_empty

LEVEL_BITS = 12
HASH_BITS = 60
#: Source tables up to this many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def place(id_col: Column) -> Column:
    """The document's place in its source: 60 bits of MD5 of the id."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
            max_epochs: float = 2.0) -> DataFrame:
    """``(key, source, source_size, target)`` from ``(key, source, size)``, one row per source.

    Ranks and running sums are taken within ranges of the source table; what
    stands before (or behind) a range is added from one row per range.
    """
    by_name = F.col("source").asc_nulls_last()
    per = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    per = _ranged(per, "mix-names", by_name)
    per = _offsets(per, F.count(F.lit(1)), "before")
    rank = F.row_number().over(Window.partitionBy("range").orderBy(by_name)) + F.col("before")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))).cast("int") + 1)
    per = per.withColumn("weight", weight).withColumn("limit", F.lit(float(max_epochs)) * F.col("source_size"))
    per = _ranged(per.drop("range", "before").withColumn("ratio", F.col("limit") / F.col("weight")), "mix-ratios", F.col("ratio"), by_name)
    ranges = per.groupBy("range").agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))
    whole = ranges.agg(F.sum("size").alias("size")).first()["size"]
    if whole is None:
        return per.select("key", "source", "source_size", F.lit(None).cast("double").alias("target"))
    order = Window.partitionBy("range").orderBy("ratio", by_name)
    run = _offsets(_offsets(per, F.sum("source_size"), "done_before"), F.sum("weight"), "open_behind", behind=True)
    done = F.col("done_before") + F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    still = F.col("open_behind") + F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # what one unit of weight gets if the sources before this one stop at their limits
    unit = (F.lit(float(share)) * F.lit(whole) - F.lit(float(max_epochs)) * done) / still
    run = run.withColumn("unit", unit)
    level = run.agg(F.max(F.when(F.col("limit") > F.col("unit") * F.col("weight"), F.struct(-F.col("ratio"), F.col("unit"))))
                    .alias("level")).select("level.unit").first()["unit"]
    return per.select(
        "key", "source", "source_size",
        F.least(F.col("limit"), F.coalesce(F.lit(level).cast("double") * F.col("weight"), F.col("limit"))).alias("target"))


def _ranged(rows: DataFrame, name: str, *order: Column) -> DataFrame:
    """``rows`` written in ranges of ``order``, with the number of the range."""
    return staged(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), name)


def _offsets(rows: DataFrame, total: Column, name: str, behind: bool = False) -> DataFrame:
    """``rows`` with ``total`` over all ranges before the row's own (or behind it); one row per range is summed up."""
    others = Window.orderBy(F.col("range").desc() if behind else F.col("range")).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("range").agg(total.alias("__total"))
    sums = sums.select("range", F.coalesce(F.sum("__total").over(others), F.lit(0)).alias(name))
    return rows.join(F.broadcast(sums), "range")


def thresholds(sizes: DataFrame, per: DataFrame) -> DataFrame:
    """``per`` plus ``epochs`` (whole passes) and ``cut`` (documents up to this hash once more; null: none)."""
    per = per.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    per = per.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    goal = per.where(F.col("source_size") > 0).select("key", "budget", F.lit(-1).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    rows = sizes
    for level in (1, 2):
        shift = HASH_BITS - level * LEVEL_BITS
        bucket = F.shiftright("hash", shift)
        if level > 1:
            rows = _with_sources(rows, goal.select("key", "prefix")).where(
                F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")).drop("prefix")
            rows = staged(rows, "mix-boundary")
        hist = rows.withColumn("bucket", bucket).groupBy("key", "bucket").agg(F.sum("size").alias("size"))
        own = Window.partitionBy("key").orderBy("bucket")
        hist = _with_sources(hist, goal.select("key", "budget", "below"))
        hist = hist.withColumn("through", F.col("below") + F.sum("size").over(own))
        met = F.min(F.when(F.col("through") >= F.col("budget"), F.struct("bucket", (F.col("through") - F.col("size")).alias("before"))))
        goal = staged(hist.groupBy("key", "budget", "below").agg(met.alias("met")).where("met is not null").select(
            "key", "budget", F.col("met.bucket").alias("prefix"), F.col("met.before").alias("below")), "mix-goal")
    last = _with_sources(rows, goal).where(F.shiftright("hash", HASH_BITS - 2 * LEVEL_BITS) == F.col("prefix"))
    last = last.groupBy("key", "budget", "below", "prefix", "hash").agg(F.sum("size").alias("size"))
    through = F.col("below") + F.sum("size").over(Window.partitionBy("key").orderBy("hash"))
    last = last.withColumn("through", through).withColumn("past", F.col("through") - F.col("size"))
    met = F.min(F.when(F.col("through") >= F.col("budget"), F.struct("hash", "through", "past")))
    cut = last.groupBy("key", "budget").agg(met.alias("met")).where("met is not null").select(
        "key", F.when(F.col("met.through") - F.col("budget") < F.col("budget") - F.col("met.past"), F.col("met.hash"))
        .otherwise(F.col("met.hash") - 1).alias("cut"))
    return per.join(cut, "key", "left").select("key", "source_size", "target", "epochs", "cut")


def _with_sources(rows: DataFrame, sources: DataFrame, on: str = "key") -> DataFrame:
    """Join on the source key; every row has its source in the table or falls away."""
    small = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(sources) if small else staged(sources, "mix-sources").hint("merge"), on)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` words."""
    own = ("size", "source_size", "target", "copies", "taken")
    docs = docs.select(*[c for c in docs.columns if c not in own])
    # a null source needs a key that no source can have
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))
    sized = docs.select("*", word_count(text_or_empty(text_col)).alias("size"))
    slim = staged(sized.select(key.alias("key"), F.col(source_col).alias("source"), "size",
                               place(F.col(id_col)).alias("hash")), "mix-sizes")
    per = staged(targets(slim, weights, share, max_epochs), "mix-targets")
    per = staged(thresholds(slim.drop("source"), per), "mix-thresholds")
    out = _with_sources(sized.select("*", key.alias("__key"), place(F.col(id_col)).alias("__place")),
                        per.withColumnsRenamed({"key": "__key", "epochs": "__epochs", "cut": "__cut"}), "__key")
    copies = F.col("__epochs") + F.coalesce(F.col("__place") <= F.col("__cut"), F.lit(False)).cast("long")
    return out.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).select(
        *docs.columns, *own)
