"""A training corpus from `documents`: drop bad text, copies, near copies and benchmark text, then pack what is left.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return rows of `documents`, with whatever columns those have.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from runlens.llm import decontaminate, exact_dedup, jaccard, packing, quality
from runlens.llm.registry import table
from runlens.session import tune, written


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labelled rows among `docs` that are not held out."""
    tune(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels"), quality.learnable()))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the one with the largest id."""
    tune(spark)
    return exact_dedup.drop_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by a similarity of 0.8 in five-word shingles."""
    tune(spark)
    return jaccard.drop_near_copies(docs, k=5, threshold=Fraction(4, 5))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten consecutive words with a benchmark item, and hold no shorter item."""
    tune(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, similar documents together."""
    tune(spark)
    return packing.packed_pieces(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_text),
    ("exact_dedup", no_copies),
    ("ngram_jaccard_join", no_near_copies),
    ("benchmark_decontamination", no_benchmark),
    ("packing", packed),
]

# a trained model and a tokenizer have no SQL; tests hold the stages against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
