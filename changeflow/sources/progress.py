"""SRC-12: streaming progress records → batch samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROGRESS_SCHEMA = "batchId bigint, durationMs map<string,bigint>, inputRowsPerSecond double, timestamp string"


def progress_metrics(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """(batch_id, ts, trigger_ms, input_rows_per_second) from progress JSON lines.

    ``trigger_ms`` is ``durationMs.triggerExecution``: the batch duration the
    batch-overrun rule and panel watch. ``ts`` is when the trigger began.
    """
    p = lines.select(F.from_json(F.col(text_col), PROGRESS_SCHEMA).alias("p")).filter(F.col("p").isNotNull())
    return p.select(F.col("p.batchId").alias("batch_id"), F.try_to_timestamp("p.timestamp").alias("ts"),
                    F.try_element_at("p.durationMs", F.lit("triggerExecution")).alias("trigger_ms"),
                    F.col("p.inputRowsPerSecond").alias("input_rows_per_second"))


def progress_samples(progress: DataFrame, app: str = "app", query: str = "query") -> DataFrame:
    """Progress rows as samples named like the driver's streaming gauges, at the time their trigger began.

    Records without a time can't be placed and give no sample.
    """
    empty = F.create_map().cast("map<string,string>")
    base = f"metrics_app_{app}_driver_spark_streaming_{query}_"
    return progress.filter(F.col("ts").isNotNull()).select("ts", F.explode(F.array(
        F.struct(F.lit(base + "triggerExecution_Value").alias("metric"), F.col("trigger_ms").cast("double").alias("value")),
        F.struct(F.lit(base + "inputRate_total_Value").alias("metric"), F.col("input_rows_per_second").alias("value")),
    )).alias("s")).select("ts", "s.metric", empty.alias("labels"), "s.value")


SOURCES_SCHEMA = ("batchId bigint, sources array<struct<description:string, startOffset:string, "
                  "endOffset:string, latestOffset:string, numInputRows:bigint>>")
OFFSETS = "map<string,map<string,bigint>>"


def progress_offsets(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Per batch and source partition: consumed (end) and available (latest)
    offsets from progress records, and their difference as lag.

    Broker sources report ``{topic: {partition: offset}}`` for ``endOffset``
    and ``latestOffset``; this reads the high watermark the consumer itself
    saw, so no topic scan is needed for latest offsets or lag. Sources with
    other offset formats (files) yield no rows.
    Returns (batch_id, topic, partition, end_offset, latest_offset, lag).
    """
    p = lines.select(F.from_json(F.col(text_col), SOURCES_SCHEMA).alias("p")).filter(F.col("p").isNotNull())
    src = p.select(F.col("p.batchId").alias("batch_id"), F.explode("p.sources").alias("s")).select(
        "batch_id", F.from_json("s.endOffset", OFFSETS).alias("end"),
        F.from_json("s.latestOffset", OFFSETS).alias("latest"))
    topics = src.select("batch_id", "latest", F.explode("end").alias("topic", "parts"))
    rows = topics.select("batch_id", "topic", "latest", F.explode("parts").alias("partition", "end_offset"))
    latest = F.try_element_at(F.try_element_at("latest", F.col("topic")), F.col("partition"))
    return rows.select("batch_id", "topic", "partition", "end_offset", latest.alias("latest_offset"),
                       F.greatest(F.lit(0), latest - F.col("end_offset")).alias("lag"))


def latest_from_progress(offsets: DataFrame) -> DataFrame:
    """SRC-7 from the consumer's side: newest reported high watermark per
    (topic, partition), as (topic, partition, latest_offset)."""
    return offsets.groupBy("topic", "partition").agg(
        F.max_by("latest_offset", "batch_id").alias("latest_offset"))
