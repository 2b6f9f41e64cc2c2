"""The corpus pipeline: quality rules, line dedup, near-duplicate join, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as Parquet in the shared
folder and reads it again for the next. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.llm import decontaminate, line_dedup, mixing, ngram_join, quality_rules
from dockyard.llm.shared import documents, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules.filtered(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines go but for one copy; `n_chars` follows the text."""
    out = line_dedup.deduped(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return ngram_join.deduped(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once per epoch that the mix takes of it."""
    return mixing.mixture(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


#: The near-duplicate and decontamination stages have no form in SQL; tests hold the result against brute force.
ORACLE_SQL = None
