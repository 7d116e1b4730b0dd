"""SRC-3: change-event encoding (row state + change fields under ``payload``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode_envelope(
    changes: DataFrame,
    key: str,
    payload_cols: Sequence[str],
    topic: str,
    partition_col: str = "partition",
    offset_col: str = "offset",
    timestamp_col: str = "timestamp",
    tombstones: bool = False,
    extra_cols: Sequence[str] = (),
) -> DataFrame:
    """Wrap each change row as a message with a JSON ``{"payload": {...}}`` value.

    Deletes are the same row with ``__deleted="true"``; with ``tombstones=True``
    each delete is followed by a message with the same key and a NULL value at
    ``offset + 1`` (callers leave that offset free). Null fields are left out
    of the JSON, as the producer does.
    """
    value = F.to_json(F.struct(F.struct(*payload_cols).alias("payload")))
    msgs = changes.select(
        F.col(key).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col(partition_col).cast("int").alias("partition"),
        F.col(offset_col).cast("bigint").alias("offset"),
        F.col(timestamp_col).cast("timestamp").alias("timestamp"),
        *extra_cols,
    )
    if not tombstones:
        return msgs
    deletes = changes.filter(F.col("__deleted") == "true").select(
        F.col(key).cast("binary").alias("key"),
        F.lit(None).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col(partition_col).cast("int").alias("partition"),
        (F.col(offset_col).cast("bigint") + 1).alias("offset"),
        F.col(timestamp_col).cast("timestamp").alias("timestamp"),
        *extra_cols,
    )
    return msgs.unionByName(deletes)
