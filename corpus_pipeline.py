"""Corpus pipeline over `documents`.

Quality rules, line dedup, near-duplicate removal, benchmark decontamination
and mixing to target weights.  Each stage takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next stage's
docs; all but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, line_dedup, mixing, ngram_join, quality_mcd
from strata.llm.common import table
from strata.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outlier of their language
    and source."""
    return quality_mcd.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document or line has;
    n_chars follows the text."""
    cut = line_dedup.line_dedup(docs)
    changed = F.col("n_lines_removed") > 0
    return cut.select(*[
        F.when(changed, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture and how often it uses each (copies)."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("dedup_lines", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

# Robust outlier models, similarity joins and template matching are beyond
# SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows go to a table in the
    shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
