"""Residual-leak feedback loop as table jobs.

1. residual scan: detect again on the *redacted* text and keep the entities
   that do not overlap a replacement token (the leaks);
2. quarantine: raw records of files with a leak (left semi join on the file),
   and the clean complement (left anti join);
3. training examples: spans an outside scanner reports on quarantined raw
   records, re-cut from the raw text, minus spans that were already redacted
   (both grouped by record, then one sweep over starts and ends);
4. training set: examples deduplicated by (text, type) with counts;
5. leak alerts per (file, type) and a per-type review sample.

The joins are keyed by record, or by file against a list of files that is
measured first (``quarantine``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.detect import explode_entities, with_entities
from ..operators.findings import cut_spans
from ..operators.merge import let, walk_blocks
from ..session import materialize
from ..sources.ledger import append_run, is_committed, read_runs


def replacement_spans(records_desc: Column) -> Column:
    """Where the replacement tokens sit in the redacted text.

    ``records_desc`` are redaction records of disjoint entities in
    application (descending) order; returns ``array<struct<start_pos,end_pos>>``
    ascending, in redacted-text offsets.
    """
    def grown(r):
        return F.length(r["replacement"]) - (r["end_pos"] - r["start_pos"])

    def span(shift, r):
        s = r["start_pos"] + shift
        return F.struct(s.cast("int").alias("start_pos"),
                        (s + F.length(r["replacement"])).cast("int").alias("end_pos"))

    # block-wise, like the overlap walk: the state is the shift so far
    kind = "struct<start_pos:int,end_pos:int>"
    return let(F.reverse(records_desc), lambda asc: walk_blocks(
        asc, F.lit(0), "int", lambda shift, r: (shift + grown(r)).cast("int"),
        span, kind, lambda shift: F.lit(None).cast(kind)))


def outside(spans: Column, taken: Column) -> Column:
    """The elements of ``spans`` that overlap none of ``taken`` (structs with ``start_pos`` and ``end_pos``).

    One sweep: a span is met by its end, a taken one by its start; a span
    overlaps one that began before its end if any of those ends behind its
    start, so the largest end so far is all the state. Sorting aside, the work
    is linear in both. The order of ``spans`` is kept.
    """
    none = F.lit(None).cast("int")
    events = F.sort_array(F.concat(
        F.transform(spans, lambda e, i: F.struct(e["end_pos"].alias("at"), F.lit(0).alias("kind"), e["start_pos"].alias("x"), i.cast("int").alias("i"))),
        F.transform(taken, lambda s: F.struct(s["start_pos"].alias("at"), F.lit(1).alias("kind"), s["end_pos"].alias("x"), none.alias("i")))))
    free = let(events, lambda es: F.sort_array(walk_blocks(
        es, none, "int", lambda far, e: F.when(e["kind"] == 1, F.greatest(far, e["x"])).otherwise(far),
        lambda far, e: F.when((e["kind"] == 0) & (far.isNull() | (far <= e["x"])), e["i"]), "int", lambda far: none)))
    return F.when((F.size(spans) == 0) | (F.size(taken) == 0), spans).otherwise(
        F.transform(free, lambda i: F.get(spans, i)))


def with_residual_leaks(df: DataFrame, redacted_col: str, spans_col: str,
                        out_col: str = "leaks", types=None) -> DataFrame:
    """Detect on the redacted text; keep entities outside the replacement spans."""
    d = with_entities(df, redacted_col, "__ss_res", types=types)
    return d.withColumn(out_col, outside(F.col("__ss_res"), F.col(spans_col))).drop("__ss_res")


#: File lists up to this many rows are broadcast.
BROADCAST_FILES = 200_000


def quarantine(raw: DataFrame, leaks: DataFrame, file_col: str = "source_file", row_keys=None):
    """(quarantined, clean): raw rows of files with / without a leak.

    There are few files and many rows per file, so a join on the file would
    send all raw text to a few reducers. The list of files is written and
    counted; up to ``BROADCAST_FILES`` rows it is broadcast and no raw row
    moves. A longer list is joined by a shuffle on a salted key: every file
    is repeated once per salt, so one file's rows spread over the salts.
    """
    files = materialize(leaks.select(file_col).distinct(), "quarantine-files")
    if files.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES:
        files = F.broadcast(files)
        return (raw.join(files, on=file_col, how="left_semi"),
                raw.join(files, on=file_col, how="left_anti"))
    salts = 64
    salt = F.pmod(F.xxhash64(*(row_keys or raw.columns)), F.lit(salts))
    dealt_files = files.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    salted = raw.withColumn("__salt", salt)
    return (salted.join(dealt_files, on=[file_col, "__salt"], how="left_semi").drop("__salt"),
            salted.join(dealt_files, on=[file_col, "__salt"], how="left_anti").drop("__salt"))


def training_examples(quarantined: DataFrame, findings: DataFrame, redacted: DataFrame,
                      key_cols, text_col: str = "text",
                      file_col: str = "source_file") -> DataFrame:
    """Outside-scanner spans on quarantined raw rows that the redaction missed.

    ``findings``: (keys, begin_offset, end_offset, type, source[, ...]);
    ``redacted``: long table of already-redacted spans (keys, start_pos, end_pos).
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    found = F.struct(F.col("begin_offset").cast("int").alias("start_pos"), F.col("end_offset").cast("int").alias("end_pos"),
                     "type", "source")
    taken = F.struct(F.col("start_pos").cast("int").alias("start_pos"), F.col("end_pos").cast("int").alias("end_pos"))
    # per record both lists are as long as its text allows; the text meets them once
    q = quarantined.select(*keys, file_col, F.col(text_col).alias("__text")).join(
        findings.groupBy(*keys).agg(F.sort_array(F.collect_list(found)).alias("__found")), on=keys, how="inner").join(
        redacted.groupBy(*keys).agg(F.collect_list(taken).alias("__taken")), on=keys, how="left")
    missed = outside(F.col("__found"), F.coalesce("__taken", F.array().cast("array<struct<start_pos:int,end_pos:int>>")))
    rows = F.transform(cut_spans(F.col("__text"), missed), lambda s: F.struct(F.lit(True).alias("here"), s.alias("s")))
    return explode_entities(q.withColumn("__missed", rows), [*keys, file_col], "__missed").select(
        *keys, file_col, "s.text", F.col("s.start_pos").alias("begin_offset"), F.col("s.end_pos").alias("end_offset"),
        "s.type", "s.source")


def training_set(examples: DataFrame, file_col: str = "source_file", keys=("text", "type")) -> DataFrame:
    """Deduplicated training set: one row per ``keys`` with its count and the
    first file it came from. The default merges examples of one text and type;
    ``("text", "begin_offset", "end_offset", "type")`` keeps places apart.

    Files are counted per example first, a hash aggregate with partial sums;
    the smallest (a string ``min`` needs a sort) is found over those few rows.
    """
    keys = list(keys)
    per_file = examples.groupBy(*keys, file_col).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(*keys).agg(
        F.sum("n").alias("n_examples"), F.min(file_col).alias("first_source_file"))


def write_training_set(training: DataFrame, path: str, fmt: str = "jsonl", append: bool = True) -> None:
    """Append (or overwrite) a training set as ``jsonl``, ``csv`` or ``parquet``."""
    w = training.write.mode("append" if append else "overwrite")
    if fmt == "jsonl":
        w.json(path)
    elif fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"Unknown format '{fmt}'. Available: ['jsonl', 'csv', 'parquet']")


def grow_training_set(training: DataFrame, base: str, run_id: str, keys=("text", "type")) -> DataFrame:
    """Add to the set below ``base`` what it does not hold yet; returns the whole set.

    The set is a dataset of committed runs (``sources.ledger``): a run adds one
    folder and rewrites none, a run that died leaves nothing, and a rerun, under
    the same id or a new one, adds nothing. Only the keys of the set are read.
    Null-safe on the keys; counts stay those of the run that brought the key.
    """
    spark, keys = training.sparkSession, list(keys)
    if not is_committed(spark, base, run_id):
        held = read_runs(spark, base, training.schema).select(*[F.col(k).alias(f"__held_{k}") for k in keys]).distinct()
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__held_{k}"))
        append_run(training.join(held, same, "left_anti"), base, run_id)
    return read_runs(spark, base, training.schema)


def leak_alerts(leaks: DataFrame, file_col: str = "source_file") -> DataFrame:
    return leaks.groupBy(file_col, "entity_type").agg(F.count(F.lit(1)).alias("n_leaks"))


def review_sample(examples: DataFrame, per_type: int, order_cols) -> DataFrame:
    """The ``per_type`` examples per type with the smallest hash of
    ``order_cols`` (a deterministic pseudo-random sample). Catalyst plans the
    rank filter as a per-partition group limit before the shuffle, so a hot
    type is cut down map-side."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in order_cols]))
    w = Window.partitionBy("type").orderBy(h, *order_cols)
    return (examples.withColumn("sample_rank", F.row_number().over(w))
            .where(F.col("sample_rank") <= per_type))


def explode_leaks(df: DataFrame, keys, col: str = "leaks") -> DataFrame:
    return explode_entities(df, keys, col)
