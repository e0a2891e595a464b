"""The operators over their whole tables, and the SQL that their results must equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmart.llm.decontaminate import contaminated, find_contamination, hit_words
from tickmart.llm.hard_negatives import mine_negatives
from tickmart.llm.language import identify_languages, learn_languages
from tickmart.llm.ngram_join import ngram_links
from tickmart.llm.oracles import ORACLES  # noqa: F401  what the entry point registers beside QUERIES
from tickmart.llm.packing import pack
from tickmart.llm.piece_encoding import decode_pieces, encode_pieces
from tickmart.llm.quality import COUNTS, judge_quality, learn_quality
from tickmart.llm.sharding import shards
from tickmart.llm.spelling import group_spellings
from tickmart.llm.suffix_dedup import repeats, text_key
from tickmart.llm.token_counts import token_counts
from tickmart.llm.urls import Rule, judge_urls
from tickmart.llm.warc import capture_records, resolve_revisits
from tickmart.session import materialize

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
TOKEN_LIMIT = 1024
SHARDS = 8
RULES = [
    Rule("com", "/", True),
    Rule("example.com", "/en/", False),
    Rule("www.example.com", "/en/", True),
    Rule("net", "/es/", False),
    Rule("net", "/fr/", False),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])
    lost = repeats(docs).select(
        F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), removed.alias("removed"), F.size("spans").cast("bigint").alias("spans"), F.sha2("kept", 256).alias("rest")
    )
    lost = materialize(lost, "lost")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", *text_key(text), F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole"))
    joined = rows.join(lost, (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("spans", F.lit(0).cast("bigint")).alias("n_spans"),
        F.coalesce("rest", "whole").alias("kept_sha256"),
    )


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(capture_records(table(spark, sf_dir, "pages")))
    fields = {"etag": "etag", "content_length": "content-length", "date": "date", "expires": "expires"}
    named = [F.element_at("headers", F.lit(field)).alias(name) for name, field in fields.items()]
    return found.select("record_id", "canonical_url", "resolved_id", "outcome", *named)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_links(table(spark, sf_dir, "documents")).select("doc_id", "copy_of", "class_id", "n_links")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    found = identify_languages(docs, learn_languages(docs.where(~held_out)))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("best").alias("lang_pred"), "score", (F.col("lang") == "und").alias("rejected"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), TOKEN_LIMIT)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    found = found.withColumn("n_hit", hit_words())
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = learn_quality(docs, table(spark, sf_dir, "labels"))
    return judge_quality(docs, rules).select("doc_id", *COUNTS, "base_failed", "kept", "reason")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECES)
    found = encode_pieces(table(spark, sf_dir, "documents"), model)
    found = found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        # the bytes that the pieces cover
        (F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)) - F.col("begin")).cast("bigint").alias("n_bytes"),
        "ids",
    )
    decoded = decode_pieces(found, model)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "n_bytes")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, seventh = table(spark, sf_dir, "embeddings"), F.col("vec_id") % 7 == 0
    moved = vectors.select("vec_id", "embedding", F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return mine_negatives(moved, F.col("vec_id") % 100 == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_suffix_dedup, op3_warc_revisits, op4_ngram_join, op5_sharding,
        op6_language_id, op7_token_counts, op8_decontamination, op9_quality_rules, op10_url_filters,
        op11_piece_encoding, op12_hard_negatives, op13_spelling_variants,
    )
}
