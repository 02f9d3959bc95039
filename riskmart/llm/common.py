"""Names, keys and text measures that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; empty for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def keyed(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """``id, th, text`` and the columns ``keep``: a key without nulls, and the text.

    ``id`` is doc_id (null: the smallest long), ``th`` a hash of the text that keeps rows apart which share
    a doc_id. Rows equal in both are one document to the operators: they get the same result, and none of
    them counts as a copy of the other.
    """
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("th"), text.alias("text"), *keep)


def with_key(docs: DataFrame) -> DataFrame:
    """``row`` (all columns as they came, whatever their names), ``id`` and ``th`` as in :func:`keyed`."""
    text = F.col("text").cast("string")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("th"))


def id_out(column: str | Column = "id") -> Column:
    """``id`` of :func:`keyed` as doc_id again."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != NULL_ID, column)
