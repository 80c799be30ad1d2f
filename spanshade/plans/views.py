"""Input views over the driver tables, shared by the registered queries.

Every view is derived from the given tables with plain projections, so the
work grows with them. The SQL fragments below are written in the subset of
SQL that Spark and DuckDB read the same way; the DuckDB cross-checks use the
very same text.

* ``corpus``   (src, key, source_file, text): ``documents`` text plus the
  conversations with a seeded PII sentence appended (``conversations`` and
  ``documents`` lack phone numbers, SSNs, ZIP codes and names).
* ``payloads`` call-transcript payloads built from ``conversations``:
  verbatim_id, call_id, ordinal, type, source_file, sentence (the turn text)
  and notes (the seeded sentence).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import dealt

# Seeded sentence per conversation turn (same text in Spark and DuckDB). Ids
# enter by remainders of fixed width, so the mix of PII does not change with
# the size of the tables. One template in four has PII of every type; the
# others are near misses (digit runs of other lengths, "I am" without a name,
# combining marks) and single hits.
_C3 = "lpad(cast(conv_id % 1000 as string),3,'0')"
_T4 = "lpad(cast(turn % 10000 as string),4,'0')"
_ZIP = "cast(10000 + conv_id % 80000 as string)"
_PLUS4 = "cast(1000 + turn % 9000 as string)"
SEEDED_NOTES_SQL = (
    "CASE (conv_id + turn) % 4 "
    f"WHEN 0 THEN concat('my name is John Smith. SSN ', {_C3}, '-12-', {_T4}, ' zip ', {_ZIP}, '-', {_PLUS4}, "
    f"'; ', cast(20000 + conv_id % 70000 as string), '. phone 555 ', {_C3}, ' ', {_T4}, '. or 555.123.', {_T4}, "
    f"' at ', cast(conv_id % 1000 as string), ' Main Street; My first and last name Mary Jones; mail u', "
    f"cast(conv_id % 1000 as string), '@ex.com') "
    f"WHEN 1 THEN concat('I am going home; order 1', {_C3}, {_T4}, '9 and 12', {_C3}, {_T4}, '55 for unit 7', {_T4}, "
    f"'. my name is not here, i am Sam') "
    f"WHEN 2 THEN concat('I am Zoé and I am Ann Lee; ssn ', {_C3}, '-', lpad(cast(turn % 100 as string),2,'0'), "
    f"'-', {_T4}, ' or ', {_C3}, ' 12 ', {_T4}, '; zip x', {_ZIP}, ' and ', {_ZIP}, '-12') "
    f"ELSE concat('first and last name: Bob Stone, tel. (', {_C3}, ') ', {_C3}, '-', {_T4}, ', ', {_C3}, {_C3}, {_T4}, "
    f"' a@b or u.', {_C3}, '+x@mail.example.org at ', cast(1 + turn % 900 as string), ' Old Mill Road') END"
)
PAYLOAD_KEY_SQL = "conv_id * 1000000 + turn"
CONV_SOURCE_SQL = "concat('conversations/', role)"

CORPUS_SQL = f"""
SELECT 'documents' AS src, doc_id AS key, source AS source_file, text FROM documents
UNION ALL
SELECT 'conversations' AS src, {PAYLOAD_KEY_SQL} AS key, {CONV_SOURCE_SQL} AS source_file,
       concat(text, '. ', {SEEDED_NOTES_SQL}) AS text
FROM conversations
"""

PAYLOADS_SQL = f"""
SELECT {PAYLOAD_KEY_SQL} AS verbatim_id, conv_id AS call_id, turn AS ordinal, role AS type,
       {CONV_SOURCE_SQL} AS source_file, text AS sentence, {SEEDED_NOTES_SQL} AS notes
FROM conversations
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("src"), F.col("doc_id").alias("key"),
        F.col("source").alias("source_file"), "text")
    conv = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("src"), F.expr(PAYLOAD_KEY_SQL).alias("key"),
        F.expr(CONV_SOURCE_SQL).alias("source_file"),
        F.concat("text", F.lit(". "), F.expr(SEEDED_NOTES_SQL)).alias("text"))
    return dealt(docs.unionByName(conv), ["src", "key"])


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(_payloads(spark, sf_dir), "verbatim_id")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.expr(PAYLOAD_KEY_SQL).alias("verbatim_id"), F.col("conv_id").alias("call_id"),
        F.col("turn").alias("ordinal"), F.col("role").alias("type"),
        F.expr(CONV_SOURCE_SQL).alias("source_file"), F.col("text").alias("sentence"),
        F.expr(SEEDED_NOTES_SQL).alias("notes"))


# External findings derived from the corpus text (stand-in for model output):
# (needle, shift, length, type, score, source); one span for every occurrence
# of the needle, moved right by ``shift``, ``length`` characters long. No
# needle can overlap itself, so occurrences are the gaps of a split.
FINDING_RULES = (
    ("John Smith", 0, 10, "PERSON", 0.95, "COMPREHEND"),
    ("Main Street", 0, 11, "ADDRESS", 0.9, "COMPREHEND"),
    ("Mary Jones", 0, 10, "NAME", 0.7, "CER"),
    (" the ", 1, 3, "OTHER", 0.85, "CER"),
)


def findings(spark: SparkSession, sf_dir: str, corpus_df: DataFrame | None = None) -> DataFrame:
    """Findings table (src, key, field_name, begin_offset, end_offset, type, score,
    source); one pass over the corpus, then a running sum per record over the
    lengths between occurrences."""
    c = corpus_df if corpus_df is not None else corpus(spark, sf_dir)
    rules = F.array(*[F.struct(
        F.lit(no).alias("rule"), F.transform(F.split("text", _literal(needle), -1), F.length).alias("gaps"))
        for no, (needle, *_) in enumerate(FINDING_RULES)])
    gaps = (c.select("src", "key", F.inline(rules)).where(F.size("gaps") > 1)
            .select("src", "key", "rule", F.posexplode(F.slice("gaps", 1, F.size("gaps") - 1)).alias("i", "gap")))
    values = F.array(*[F.struct(
        F.lit(len(needle)).alias("width"), F.lit(shift).alias("shift"), F.lit(length).alias("length"),
        F.lit(etype).alias("type"), F.lit(float(score)).alias("score"), F.lit(source).alias("source"))
        for needle, shift, length, etype, score, source in FINDING_RULES])
    w = Window.partitionBy("src", "key", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = gaps.withColumn("v", F.get(values, F.col("rule")))
    begin = F.sum("gap").over(w) + F.col("i") * F.col("v.width") + F.col("v.shift")
    return found.select(
        "src", "key", F.lit("text").alias("field_name"), begin.cast("int").alias("begin_offset"),
        (begin + F.col("v.length")).cast("int").alias("end_offset"), "v.type", "v.score", "v.source")


def _literal(needle: str) -> str:
    return "\\Q" + needle + "\\E"


# A given entity table for the payloads: up to one span per field, with bad
# offsets (NULL, negative), entities of unknown payloads and payloads without
# entities among them.
GIVEN_SQL = """
SELECT verbatim_id + CASE WHEN verbatim_id % 10 = 3 THEN 5000000000000 ELSE 0 END AS verbatim_id,
       'notes' AS field_name,
       CASE WHEN verbatim_id % 50 = 8 THEN NULL WHEN verbatim_id % 50 = 7 THEN -1 ELSE 11 END AS begin_offset,
       21 AS end_offset, 'PERSON' AS type, 0.9 AS score, 'CER' AS source
FROM payloads
UNION ALL
SELECT verbatim_id, 'sentence', 0, 5, 'OTHER', 0.8, 'COMPREHEND' FROM payloads WHERE verbatim_id % 2 = 0
"""


def given_entities(payloads_df: DataFrame) -> DataFrame:
    return payloads_df.sparkSession.sql(GIVEN_SQL.replace("FROM payloads", "FROM {p}"), p=payloads_df)


# Detection results for positional pairing: one span per field, in the order
# of ``verbatim_id``; ``payloads`` and ``results`` leave out rows of one kind
# each, so that either side has more in one of two cases.
RESULT_SPANS = (("sentence", 0, 5, "OTHER"), ("notes", 11, 21, "PERSON"))


def detection_results(payloads_df: DataFrame) -> DataFrame:
    """``verbatim_id`` (the order) and ``entities_by_field``; every third record's result has no entities."""
    def entities(field, begin, end, kind):
        span = F.substring(F.col(field), begin + 1, end - begin)
        return F.array(F.struct(span.alias("text"), F.lit(kind).alias("entity_type"), F.lit(begin).alias("start_pos"),
                                F.lit(end).alias("end_pos"), F.lit(0.9).alias("confidence"), F.lit("CER").alias("source")))
    found = F.create_map(*[x for f, b, e, k in RESULT_SPANS for x in (F.lit(f), entities(f, b, e, k))])
    return payloads_df.select("verbatim_id", F.when(F.col("verbatim_id") % 3 != 0, found).alias("entities_by_field"))
