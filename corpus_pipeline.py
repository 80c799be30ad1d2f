"""Corpus pipeline: documents in, token ids out.

Five stages, each applied to all that the stage before kept, each written as
Parquet and read again as the next one's documents:

1. quality     documents that the quality classifier rejects go;
2. lines       repeated lines go from all documents but one;
3. near        of each group of near-duplicates one document stays;
4. mix         sources are mixed to their target weights (a document taken
               twice is two rows, one not taken is gone);
5. tokens      texts become ids, and ids become texts again.

All stages but the last return the columns of their input. ``n_chars`` follows
the text where a stage changes it.

Defined results: rows with null or empty texts run through every stage like
others; columns beyond those of documents are kept up to stage 4; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanshade.llm import line_dedup, mixing, piece_bpe, quality, simhash
from spanshade.llm.common import Owner, new_path, table
from spanshade.llm.queries import piece_model, quality_model

#: SQL cannot express the trained classifier, XXH64 or the tokenizer.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, score_col="__score", keep_col="__keep").where("__keep = 1").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs)
    chars = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=4, max_bits=4)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = mixing.mix(docs).where("copies > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = piece_bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), piece_model())
    return out.withColumn("n_tokens", F.size("ids").cast("long")).drop("text")


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near", near_stage), ("mix", mix_stage),
          ("tokens", token_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    owner = Owner(spark).__enter__()  # the last stage's table stays: the result reads it
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        owner.release(keep=path)  # what the stage made, and the stage before
    return docs
