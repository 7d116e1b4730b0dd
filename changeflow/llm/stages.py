"""The operators as stages of a document pipeline: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import lang_id, mixing, packing, secrets, simhash
from changeflow.llm.common import prepared


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted, with ``lang`` set to the language found."""
    prepared(spark)
    return lang_id.keep_identified(docs, "text", "lang", "source")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near copies."""
    prepared(spark)
    return simhash.keep_one(docs, shingle=3, radius=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by their kind."""
    prepared(spark)
    return secrets.redact(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights ask for."""
    prepared(spark)
    return mixing.mixed(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens with their places in sequences."""
    prepared(spark)
    return packing.pack(docs)
