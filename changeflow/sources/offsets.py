"""Offsets: consumed (from a streaming checkpoint), latest, and lag (SRC-6/7, JOIN-1, AGG-2..5, 14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_checkpoint_files(spark: SparkSession, checkpoint_dir: str, consumed_from: str = "offsets") -> DataFrame:
    """(file_name, text) of every file under ``<checkpoint>/offsets`` (one row per file).

    ``consumed_from="offsets"`` (the reference) takes the newest *planned*
    batch, which may not be written yet; ``"commits"`` keeps only batches
    that also have a file under ``commits/`` (finished batches).
    """
    root = checkpoint_dir.rstrip("/")
    # ``wholetext`` must be the keyword: ``text()`` would override the option.
    files = (spark.read.text(f"{root}/offsets", wholetext=True)
             .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text")))
    if consumed_from == "commits":
        done = spark.read.text(f"{root}/commits", wholetext=True).select(
            F.col("_metadata.file_name").alias("file_name"))
        files = committed_only(files, done)
    return files


def committed_only(files: DataFrame, commit_names: DataFrame) -> DataFrame:
    """Offsets files whose batch also has a commit file."""
    return files.join(commit_names.select("file_name").distinct(), "file_name", "left_semi")


def checkpoint_offsets(files: DataFrame, topic: str) -> DataFrame:
    """SRC-6 / AGG-5 / AGG-14: consumed offsets of ``topic`` in the newest batch file.

    The newest file is the one with the largest numeric name (names that are
    not integers are skipped). It must have at least three lines, else the
    result is empty (no fall-back to an older file); its last line is
    ``{topic: {partition: offset}}``. Returns (batch_id, topic, partition, offset).
    """
    numbered = files.select(F.expr("try_cast(file_name AS BIGINT)").alias("batch_id"), "text") \
        .filter(F.col("batch_id").isNotNull())
    newest = numbered.agg(F.max("batch_id").alias("batch_id"), F.max_by("text", "batch_id").alias("text"))
    lines = F.split(F.regexp_replace("text", r"^\s+|\s+$", ""), "\n")
    parsed = newest.select("batch_id", lines.alias("lines")).filter(F.size("lines") >= 3).select(
        "batch_id",
        F.from_json(F.element_at("lines", -1), "map<string,map<string,bigint>>").alias("offsets"))
    per_topic = parsed.select("batch_id", F.try_element_at("offsets", F.lit(topic)).alias("m"))
    return per_topic.select(
        "batch_id", F.lit(topic).alias("topic"),
        F.explode("m").alias("partition", "offset"))


def latest_offsets(messages: DataFrame) -> DataFrame:
    """SRC-7 (re-aimed): high watermark per (topic, partition) = max(offset) + 1."""
    return messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("latest_offset"))


def offset_totals(latest: DataFrame) -> DataFrame:
    """AGG-2 / AGG-3: Σ high watermark and partition count per topic."""
    return latest.groupBy("topic").agg(
        F.sum("latest_offset").alias("latest_total"),
        F.countDistinct("partition").alias("partition_count"))


def consumer_lag(consumed: DataFrame, latest: DataFrame) -> DataFrame:
    """JOIN-1: lag per consumed topic partition = max(0, latest − consumed), missing latest = 0.

    Matched on (topic, partition): topics share partition numbers. Partitions
    only present on the latest side are not counted (left join). ``latest`` has
    one row per topic partition; the planner broadcasts it when its measured
    size is under the broadcast threshold.
    """
    lat = latest.select("topic", F.col("partition").cast("string").alias("partition"), "latest_offset")
    con = consumed.select("topic", F.col("partition").cast("string").alias("partition"), "offset", "batch_id")
    j = con.join(lat, ["topic", "partition"], "left")
    return j.select("topic", "partition", "batch_id",
                    F.greatest(F.lit(0), F.coalesce("latest_offset", F.lit(0)) - F.col("offset")).alias("lag"))


def lag_total(lag: DataFrame) -> DataFrame:
    """AGG-4 / AGG-14: per topic, Σ lag and the last batch written."""
    return lag.groupBy("topic").agg(F.sum("lag").alias("lag_total"), F.max("batch_id").alias("last_batch_written"))
