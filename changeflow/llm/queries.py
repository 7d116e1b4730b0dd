"""Registered queries of this subpackage: each operator over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import (
    code_books, hamming_index, html_extract, lang_id, licenses, mixing, packing, pii, secrets, simhash, spelling, token_counts, topk,
)
from changeflow.llm.common import table
from changeflow.llm.oracles import CODES, MIXING, PII, SECRETS, SPELLING, TOP_K

SHINGLE = 3
RADIUS = 2


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=SHINGLE, radius=RADIUS)
    return got.select("doc_id", "fingerprint", "component_id")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = html_extract.extract(table(spark, sf_dir, "pages"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lang_id.identify(table(spark, sf_dir, "documents"), "text", F.col("lang"), F.col("source"))
    return got.select("doc_id", "lang", "source", "detected", "confidence", "accepted")


def pages_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over pages, where the evidence is the html element's language and the address."""
    pages = html_extract.extract(table(spark, sf_dir, "pages"))
    got = lang_id.identify(pages, "text", lang_id.html_language(F.coalesce("html", F.lit(""))), F.col("url"))
    return got.select("page_id", "url", "detected", "confidence", "accepted")


def op4_hamming_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_index.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=100, k=10, scale=1024)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_code_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_books.compress(table(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), packing.tokenizer_path(), packing.tokenizer_path(packing.RANKS))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_html_extract, op3_lang_id, pages_lang_id, op4_hamming_index, op5_secrets,
                                   op6_mixing, op7_topk, op8_pii, op9_packing, op10_licenses, op11_code_books, op12_token_counts, op13_spelling)}
ORACLE = {"op5_secrets": SECRETS, "op6_mixing": MIXING, "op7_topk": TOP_K, "op8_pii": PII, "op11_code_books": CODES, "op13_spelling": SPELLING}
