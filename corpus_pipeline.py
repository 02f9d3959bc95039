"""The corpus pipeline: documents to training mix in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it works on all that the stage before it
kept, is written as Parquet and read again as the next one's input. All but the last return the columns of
documents; the last adds how often the mix takes each document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import decontaminate, langid, line_templates, mixing, ngram_join
from riskmart.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or of no clear language go."""
    return langid.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line templates that recur across documents."""
    return line_templates.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return ngram_join.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``mix_copies``."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mix),
]

# The language stage is a trained network, which SQL cannot express; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
