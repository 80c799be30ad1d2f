"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .common import staged, table


def piece_model() -> str:
    """Where the public tokenizer's model lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk_search import scaled, top_k, usable

    vectors = table(spark, sf_dir, "embeddings").where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("id"), scaled(F.col("embedding")).alias("vec"))
    return top_k(vectors, vectors.where("id % 50 = 0"), k=5)


def remainder(n: int):
    """crc32 of the doc_id as text, modulo n: the folds of the contracts."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    model = train(docs, ~held_out)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_groups

    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import KINDS, scan, span_text

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))

    def of_kind(no: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == no)).cast("long")

    count = [of_kind(no).alias(f"n_{k[0]}") for no, k in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"), "n_example", "n_live")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import main_text, train

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages, train(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, quality_model(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def quality_model(docs: DataFrame, labels: DataFrame):
    """Trained on the labelled rows outside the held-out fold."""
    from .quality import train

    return train(docs, labels, remainder(4) != 2)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .piece_bpe import id_digest, round_trip

    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), id_digest().alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def byte_ranks() -> str:
    """Where the public tokenizer's rank file lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import round_trip

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, byte_ranks(), public_tokenizers.PATTERN, packed=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations, from ``ordered_turns``: ``(conv, depth, digest, bytes)``, and one row ``conv`` each.

    Conversation c begins with the first h(c) < 9 turns of conversation
    c - c % 5 and goes on with its own behind its first h(c).
    """
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(9))
    turn = F.struct("place", "digest", "bytes")
    heads = turns.where("conv % 5 = 0 and place <= 8").groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(turn)).alias("head"))  # eight turns at most
    convs = turns.where("place = 1").select("conv", (F.col("conv") - F.col("conv") % 5).alias("base"), h.alias("h"))
    convs = staged(convs.join(heads.hint("merge"), "base", "left").select(
        "conv", "h", F.expr("slice(coalesce(head, array()), 1, int(h))").alias("head")), "trie-plans")
    first = convs.select("conv", F.inline("head")).select("conv", F.col("place").alias("depth"), "digest", "bytes")
    lack = convs.select("conv", (F.col("h") - F.size("head")).alias("lack")).where("lack > 0")
    own = turns.where(F.col("place") > h).join(lack.hint("merge"), "conv", "left").select(
        "conv", (F.col("place") - F.coalesce("lack", F.lit(0))).alias("depth"), "digest", "bytes")
    return staged(first.unionByName(own), "trie-rebuilt"), convs.select("conv")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import ordered_turns, prefix_trie

    turns = staged(ordered_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")), "trie-ordered")
    return prefix_trie(*rebuilt_turns(turns))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import count_words, group_variants, occurrences, without_point

    runs = occurrences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    place = F.pmod(F.col("h"), F.length("word").cast("long")).cast("int")
    words = runs.withColumn("h", h).select(
        F.when(F.col("h") % 31 == 0, without_point(F.col("word"), place)).otherwise(F.col("word")).alias("word"))
    return group_variants(count_words(words))


def queries():
    return {f.__name__: f for f in (
        op1_topk_search, op2_language_id, op3_mixing, op4_simhash, op5_secret_scan, op6_html_extract, op7_line_dedup,
        op8_quality, op9_exact_dedup, op10_sentencepiece, op11_byte_bpe, op12_prefix_trie,
        op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracle.SQL.items() if k in queries()}
