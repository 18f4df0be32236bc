"""Pieces that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# rows of one Arrow batch: texts can be long, so a batch is kept small
BATCH_ROWS = 256


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. `lower` does the same, faster, where every character is one byte."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def small_batches(spark: SparkSession) -> None:
    """Bound what an Arrow batch holds. Applies to plans that start afterwards."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only `_id` and `_text` (null: empty), so that no other column of `docs` can clash."""
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_id`, `_text` (null: empty) and all columns of `docs` as the struct `_row`; `unpacked` gives them back."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(whole, F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")
