"""One query per corpus operator, over its whole table, and the SQL that some can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_tree, collocations, conversation_repair, exact_dedup, mixing, oracles, partenum_join, pii, quality_classifier, quality_rules,
    secrets, suffix_dedup, toxicity, url_reputation,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum_join.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=85)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels stand for the outcomes of the pages with their number: bad if low in quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_reputation.filter_urls(table(spark, sf_dir, "pages"), outcomes)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("mark")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    return bpe_tree.code_digests(table(spark, sf_dir, "documents"), path)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return pii.base_digest(found).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_summary(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_secret_scan": op7_secret_scan,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_pii": op10_pii,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": oracles.OP1_QUALITY_RULES,
    "op4_url_filter": oracles.OP4_URL_FILTER,
    "op11_conversation_repair": oracles.OP11_CONVERSATION_REPAIR,
    "op13_collocations": oracles.OP13_COLLOCATIONS,
    "op3_exact_dedup": """
        WITH n AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
          FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM n""",
}
