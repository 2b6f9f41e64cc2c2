"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockyard.llm import (
    decontaminate,
    exact_dedup,
    language_crf,
    line_dedup,
    mixing,
    ngram_join,
    phrase_mining,
    pii,
    quality_model,
    quality_rules,
    secret_scan,
    token_alignment,
    token_counts,
)
from dockyard.llm.oracle import ORACLE_SQL as ORACLE_SQL
from dockyard.llm.shared import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


#: The vocabulary whose tokens op1 counts; any file of the public tokenizers may be named.
VOCABULARY = "byte_bpe_50k.json"


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.digest(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(documents(spark, sf_dir))


@_query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(documents(spark, sf_dir))


@_query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(documents(spark, sf_dir))


@_query
def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.digest(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@_query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(documents(spark, sf_dir))


@_query
def op9_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.digest(documents(spark, sf_dir))


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(documents(spark, sf_dir))


@_query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.digest(documents(spark, sf_dir))


#: The two vocabularies that op12 aligns: byte-level BPE, and sentencepiece.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


@_query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_alignment.digest(documents(spark, sf_dir), *map(public_tokenizers.path, ALIGNED))


@_query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest(documents(spark, sf_dir))
