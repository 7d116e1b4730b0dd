"""Documents to packed training sequences, in five stages.

Language ID drops documents without an accepted language and sets ``lang``;
near-dedup keeps one document of each group; the secret scan masks secrets in
the texts; mixing reads each source as often as its target weight asks for;
packing cuts and places the tokens. Each stage takes (spark, docs, sf_dir) and
works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import stages
from changeflow.llm.common import staged, table

STAGES = [
    ("language ID", stages.language_id),
    ("SimHash near-dedup", stages.near_dedup),
    ("secret scans", stages.secret_scan),
    ("mixing to target weights", stages.mixing_weights),
    ("best-fit packing", stages.best_fit),
]

# SQL has no XXH64 and no byte-pair encoding; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
