"""Message scans (SRC-1) and the permissive JSON parse (PRJ-1, PRJ-2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.schemas import ENVELOPE_SCHEMA, MESSAGE_SCHEMA
from changeflow.sources.message_table import message_table


@dataclass(frozen=True)
class MessageSource:
    """Where change messages come from.

    ``format="kafka"`` needs the broker connector on the classpath;
    ``"message_table"`` reads a Parquet table of messages by offset ranges
    (``sources.message_table``; give ``checkpoint`` for it to keep the limit
    across restarts); any file
    format (``parquet`` by default) reads directories of files that carry the
    six message columns, which is how tests replay a change log.
    """

    path_or_topic: str
    format: str = "parquet"
    bootstrap_servers: str | None = None
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_per_trigger: int | None = 2_000_000  # offsets, for a broker
    max_files_per_trigger: int | None = None  # files, for a file source
    checkpoint: str | None = None  # the query's, for a message table


def read_messages(spark: SparkSession, source: MessageSource) -> DataFrame:
    """SRC-1: a streaming DataFrame(key, value, topic, partition, offset, timestamp)."""
    reader = spark.readStream.format(source.format)
    if source.format == "kafka":
        reader = (
            reader.option("kafka.bootstrap.servers", source.bootstrap_servers)
            .option("subscribe", source.path_or_topic)
            .option("startingOffsets", source.starting_offsets)
            .option("failOnDataLoss", str(source.fail_on_data_loss).lower())
        )
        if source.max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(source.max_per_trigger))
        return reader.load()
    if source.format == "message_table":
        spark.dataSource.register(message_table())
        options = {"path": source.path_or_topic, "failOnDataLoss": str(source.fail_on_data_loss).lower(),
                   "maxOffsetsPerTrigger": str(source.max_per_trigger or 0), "checkpoint": source.checkpoint or ""}
        return reader.options(**options).load()
    reader = reader.schema(MESSAGE_SCHEMA)
    if source.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(source.max_files_per_trigger))
    return reader.load(source.path_or_topic)


def parse_messages(msgs: DataFrame, schema: T.StructType = ENVELOPE_SCHEMA) -> DataFrame:
    """PRJ-1/PRJ-2: bytes to text, rename the broker time, parse once.

    ``from_json`` is permissive: unknown fields are ignored and wrong-typed
    scalars become null, so a bad message never fails the job.

    The parse is produced by a one-element ``explode``: predicates on
    ``parsed`` (the route filters) cannot be pushed below a generator, so the
    JSON is parsed once per message instead of once per predicate reference,
    while predicates on broker columns (offset, partition) still reach the scan.
    """
    text = F.col("value").cast("string")
    return msgs.select(
        F.col("key").cast("string").alias("kafka_key"),
        text.alias("json_str"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.explode(F.array(F.from_json(text, schema))).alias("parsed"),
    )


def payload_field(name: str) -> Column:
    return F.col("parsed.payload").getField(name)
