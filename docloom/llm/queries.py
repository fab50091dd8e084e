"""The registered queries: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import alignment, centroids, chat_format, decontaminate, exact_dedup, html_extract, language_id, mixing, ngram_jaccard, quality, secret_scan, token_counts, warc
from docloom.llm.oracles import ORACLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Vocabulary files of public tokenizers; set DOCLOOM_TOKENIZERS where they lie elsewhere.
TOKENIZERS = os.environ.get("DOCLOOM_TOKENIZERS", "/opt/tokenizers")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    every = F.array_sort(F.concat("base", "extra"))
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"), secret_scan.span_text(every).alias("spans"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    chats = chat_format.format_chats(turns.unionByName(extra)).withColumn("learnt", chat_format.loss_text())
    lines = F.concat_ws("", F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return chats.select(
        "conv_id", F.size("parsed").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rate_documents(table(spark, sf_dir, "documents"), quality.trusted_ids(table(spark, sf_dir, "labels")))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


QUERIES = (
    op1_token_counts, op2_secret_scans, op3_warc, op4_ngram_jaccard, op5_html_extraction,
    op6_language_id, op7_mixing, op8_exact_dedup, op9_chat_formatting, op10_decontamination,
    op11_centroid_clustering, op12_quality_rules, op13_cross_tokenizer_alignment,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in ORACLES.items() if name in queries()}
