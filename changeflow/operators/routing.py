"""Routing and projections of parsed change messages (FLT-1..7, PRJ-3..7).

One ``route`` column splits the input into three disjoint branches:

* ``good``    struct present, key present, ``__deleted`` = "false" (any value
              other than "true", but not NULL: three-valued logic);
* ``dead``    no struct, no payload or no key (tombstones and bad text);
* ``dropped`` keyed rows flagged as deletes or without a delete flag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.operators.latest import precombine
from changeflow.schemas import NUM_BUCKETS, RECORD_KEY, ROW_COLUMNS
from changeflow.sources.messages import payload_field


def route_column() -> Column:
    key = payload_field(RECORD_KEY)
    deleted = payload_field("__deleted")
    return (
        F.when(F.col("parsed").isNull() | key.isNull(), F.lit("dead"))
        .when(deleted != "true", F.lit("good"))
        .otherwise(F.lit("dropped"))
    )


def reason_column() -> Column:
    deleted = payload_field("__deleted")
    return (
        F.when(F.col("json_str").isNull(), F.lit("null_value"))
        .when(F.col("parsed").isNull(), F.lit("empty_value"))
        .when(F.col("parsed.payload").isNull(), F.lit("no_payload"))
        .when(payload_field(RECORD_KEY).isNull(), F.lit("no_key"))
        .when(deleted == "true", F.lit("delete"))
        .when(deleted.isNull(), F.lit("unflagged"))
        .otherwise(F.lit("ok"))
    )


def route(parsed: DataFrame) -> DataFrame:
    """FLT-1..3 / SET-1: add ``route`` and ``reason`` (disjoint and total)."""
    return parsed.withColumn("route", route_column()).withColumn("reason", reason_column())


def project_rows(good: DataFrame, keep_position: bool = True, extra: Sequence[str] = ()) -> DataFrame:
    """PRJ-3..6: the 13 lake columns (+ broker position for tie-breaks).

    ``ts`` = ``__source_ts_ms`` as a timestamp (millisecond precision), ``dt`` =
    its UTC date as ``yyyy-MM-dd``; ``__op`` becomes ``cdc_operation``. ``extra``
    names columns of ``good`` that pass (``sources.unknown``).
    """
    ts = F.timestamp_millis(payload_field("__source_ts_ms"))
    cols = [payload_field(c).alias(c) for c in ROW_COLUMNS] + [
        payload_field("__op").alias("cdc_operation"),
        ts.alias("ts"),
        F.date_format(ts, "yyyy-MM-dd").alias("dt"),
    ]
    if keep_position:
        cols += [F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset")]
    cols += [F.col(c) for c in extra]
    return good.select(*cols)


def good_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == "good")


def dead_letters(routed: DataFrame) -> DataFrame:
    """PRJ-7 / SNK-2 projection: original key and text, unchanged."""
    return routed.filter(F.col("route") == "dead").select(
        F.col("kafka_key").alias("key"), F.col("json_str").alias("value")
    )


def dropped_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == "dropped")


def bucket_of(key: Column, n: int = NUM_BUCKETS) -> Column:
    """TBL-2: hash bucket of the record key, by the first 32 bits of its MD5 (so any engine can compute it)."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def point_lookup(view: DataFrame, key_value: str, key: str = RECORD_KEY) -> DataFrame:
    """FLT-4: rows of one key. On a table bucketed by the key, Spark reads that key's bucket only."""
    return view.filter(F.col(key) == F.lit(key_value))


def point_update(view: DataFrame, key_value: str, values: dict, ts_ms: int, partition: int,
                 offset: int, key: str = "tracking_id") -> DataFrame:
    """FLT-6: ``UPDATE ... SET values WHERE key = key_value`` as a one-row change batch.

    The new row state is the key's newest row with ``values`` applied, stamped
    with the update time (which also decides its ``dt``).
    """
    cur = view.filter(F.col(key) == F.lit(key_value))
    newest = precombine(cur, [key], ["ts", "kafka_partition", "kafka_offset"])
    ts = F.timestamp_millis(F.lit(ts_ms))
    sets = {c: F.lit(v) for c, v in values.items()} | {
        "cdc_operation": F.lit("u"), "ts": ts, "dt": F.date_format(ts, "yyyy-MM-dd"),
        "kafka_partition": F.lit(partition).cast("int"), "kafka_offset": F.lit(offset).cast("bigint"),
    }
    return newest.select(*[sets[c].alias(c) if c in sets else F.col(c) for c in newest.columns])


def peek(df: DataFrame, n: int = 10, order: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """SRT-2: first ``n`` rows by broker position (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def latest_sorted(view: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """SRT-1: ORDER BY over the snapshot view."""
    return view.select(*cols).orderBy(*by)
