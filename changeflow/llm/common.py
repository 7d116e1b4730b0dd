"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import checkpoint_root, scratch_dir

# Texts reach Python in batches of this many rows, so that a batch of very
# long documents still fits beside the executor's heap.
ARROW_ROWS = 256
_SHIPPED: dict[str, Any] = {}


def shipped(spark: SparkSession) -> None:
    """Hand this package to the Python workers, unless their path has it."""
    package = Path(__file__).resolve().parent.parent
    sc = spark.sparkContext
    there = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(package.parent) in there or _SHIPPED.get("to") == sc.applicationId:
        return
    # The driver serves this file while the application runs.
    _SHIPPED["from"] = here = tempfile.TemporaryDirectory()
    sc.addPyFile(shutil.make_archive(f"{here.name}/{package.name}", "zip", package.parent, package.name))
    _SHIPPED["to"] = sc.applicationId


def prepared(spark: SparkSession) -> SparkSession:
    """Pin the session settings the operators rely on (idempotent)."""
    shipped(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage so that a lost executor costs one read, and gives the
    planner the real size, which decides between broadcast and shuffle.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Small loop states: a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    root = checkpoint_root(df.sparkSession)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return df.checkpoint()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names starting with ``names`` that no column of ``df`` has (case ignored)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out
