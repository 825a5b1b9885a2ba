"""The registered queries of the operators: thin applications with
production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (chat_windows, decontam, html_extract, language_mixture, line_dedup, merkle, mixing,
                        ngram_join, oracles, pii, quality_mcd, resampling, secret_scan, token_counts)
from strata.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its near-duplicate class and link counts."""
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"))


def op2_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: base counts, base rules and the robust verdict."""
    return quality_mcd.quality_report(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: secrets by kind and position."""
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: bytes and tokens."""
    import public_tokenizers
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page: its main text."""
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its text without duplicate lines, and their number."""
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines_removed", "n_near_removed", "text")


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per use of a document in the mixture."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: personal data by kind and position."""
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation, read back from its formatted windows."""
    return chat_windows.read_back(chat_windows.windows(
        chat_windows.with_probe(table(spark, sf_dir, "conversations"))))


def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that leaks into it."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .drop("mark").distinct()


def op11_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its main language and the mixture it is part of."""
    return language_mixture.identify(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: leaf, roots, proof and its verification, with a
    fifth of the texts tampered with."""
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered_fifth())


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: weight, score and rank in the draw."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ngram_jaccard_join, op2_quality_mcd, op3_secret_scan, op4_token_counts, op5_html_extract,
        op6_line_dedup, op7_temperature_mixing, op8_pii, op9_chat_windows, op10_template_decontamination,
        op11_language_mixture, op12_merkle_manifest, op13_importance_resampling)
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": oracles.JACCARD,
    "op6_line_dedup": oracles.LINES,
    "op7_temperature_mixing": oracles.MIXING,
    "op9_chat_windows": oracles.CHAT,
    "op10_template_decontamination": oracles.TEMPLATES,
    "op12_merkle_manifest": oracles.MERKLE,
    "op13_importance_resampling": oracles.RESAMPLING,
}
