"""Inputs derived by Spark from the driver's tables (FIXTURES.md D-H).

The change log is built from ``events``: each event is one change message of
a shipment keyed by its user. Everything here is a lazy DataFrame whose size
grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.schemas import ROW_COLUMNS
from changeflow.sources.envelope import encode_envelope

TOPIC = "shipments.shipments_db.shipments"
OTHER_TOPIC = "shipments.other"
NUM_BATCHES = 10

# Message class by event_id % 50 (FIXTURES.md D).
CLASS_BY_MOD = {7: "tombstone", 11: "malformed", 13: "nokey", 17: "delete", 19: "unflagged"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def message_class(event_id: Column) -> Column:
    m = event_id % 50
    expr = F.lit("good")
    for mod, name in reversed(list(CLASS_BY_MOD.items())):
        expr = F.when(m == mod, F.lit(name)).otherwise(expr)
    return expr


def source_ts_ms(ts: Column) -> Column:
    """Epoch milliseconds, floored (``ts`` is timestamp_ntz read as UTC)."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(1000)).cast("bigint")


def change_rows(events: DataFrame) -> DataFrame:
    """One change row per event: row state + ``__deleted/__op/__source_ts_ms``.

    Columns besides the payload: ``cls`` (message class), ``b`` (batch),
    ``partition``, ``offset``, ``timestamp``.
    """
    e = events.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        message_class(F.col("event_id")).alias("cls"),
    )
    key = F.concat(F.lit("SHP-"), F.col("user_id").cast("string"))
    return e.select(
        F.col("event_id").alias("id"),
        F.when(F.col("cls") == "nokey", F.lit(None).cast("string")).otherwise(key).alias("tracking_id"),
        F.concat(F.lit("shipper-"), (F.col("user_id") % 13).cast("string")).alias("shipper_name"),
        F.concat(F.lit("city-"), (F.col("user_id") % 7).cast("string")).alias("shipper_city"),
        F.concat(F.lit("customer-"), F.col("user_id").cast("string")).alias("customer_name"),
        F.concat(F.lit("city-"), (F.col("user_id") % 5).cast("string")).alias("customer_city"),
        F.col("value").cast("decimal(10,2)").cast("string").alias("weight_kg"),
        F.col("event_type").alias("status"),
        F.col("props").alias("current_location"),
        (F.unix_date(F.to_date("ts")) + 3).cast("int").alias("estimated_delivery"),
        F.when(F.col("cls") == "delete", F.lit("true"))
        .when(F.col("cls") == "unflagged", F.lit(None).cast("string"))
        .otherwise(F.lit("false")).alias("__deleted"),
        F.when(F.col("cls") == "delete", F.lit("d")).otherwise(F.lit("u")).alias("__op"),
        source_ts_ms(F.col("ts")).alias("__source_ts_ms"),
        "cls",
        (F.col("event_id") % NUM_BATCHES).alias("b"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        key.alias("message_key"),
    )


def cdc_messages(events: DataFrame) -> DataFrame:
    """The change log as broker messages, plus the batch column ``b``.

    Classes: tombstone (NULL value), malformed (JSON cut in half), nokey,
    delete, unflagged, good.
    """
    changes = change_rows(events)
    payload = ROW_COLUMNS + ["__deleted", "__op", "__source_ts_ms"]
    msgs = encode_envelope(
        changes, key="message_key", payload_cols=payload, topic=TOPIC,
        extra_cols=["b", "cls"],
    )
    text = F.col("value").cast("string")
    value = (
        F.when(F.col("cls") == "tombstone", F.lit(None).cast("binary"))
        .when(F.col("cls") == "malformed",
              text.substr(F.lit(1), F.floor(F.length(text) / 2).cast("int")).cast("binary"))
        .otherwise(F.col("value"))
    )
    return msgs.withColumn("value", value)


# ---------------------------------------------------------------------------
# Observability inputs (FIXTURES.md E-G), derived from the change log.

CONSUMED_BATCHES = 8  # the consumer has finished batches 0..7
PROGRESS_START = 1_706_745_600  # 2024-02-01 00:00:00
STRAY_PARTITION = "99"  # consumed but unknown to the broker side
TABLE_PREFIX = "lake/shipments_mor"


def checkpoint_files(msgs: DataFrame) -> DataFrame:
    """Streaming-checkpoint ``offsets/`` files as (file_name, text).

    File ``j + 3`` holds the offsets consumed after batch j (so names 9 and 10
    exist and must compare numerically). Also: a two-line file ``2``, a
    non-numeric ``metadata`` file, a second topic, and partition 99 that the
    broker does not list.
    """
    from pyspark.sql import Window

    per = msgs.filter(F.col("b") < CONSUMED_BATCHES).groupBy("b", "partition").agg(F.max("offset").alias("mx"))
    w = Window.partitionBy("partition").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    run = per.withColumn("consumed", F.max("mx").over(w) + 1)
    files = run.groupBy("b").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("partition").cast("string"), F.col("consumed")))).alias("m"))
    stray = F.create_map(F.lit(STRAY_PARTITION), F.lit(5).cast("bigint"))
    other = F.create_map(F.lit("0"), F.lit(42).cast("bigint"))
    offsets_json = F.to_json(F.create_map(F.lit(TOPIC), F.map_concat("m", stray), F.lit(OTHER_TOPIC), other))
    meta = F.lit('{"batchWatermarkMs":0,"batchTimestampMs":0,"conf":{}}')
    normal = files.select((F.col("b") + 3).cast("string").alias("file_name"),
                          F.concat_ws("\n", F.lit("v1"), meta, offsets_json).alias("text"))
    two_line = files.filter(F.col("b") == 0).select(F.lit("2").alias("file_name"),
                                                    F.concat_ws("\n", F.lit("v1"), offsets_json).alias("text"))
    big = F.to_json(F.create_map(F.lit(TOPIC), F.transform_values("m", lambda k, v: v + 1000)))
    non_numeric = files.filter(F.col("b") == CONSUMED_BATCHES - 1).select(
        F.lit("metadata").alias("file_name"), F.concat_ws("\n", F.lit("v1"), meta, big).alias("text"))
    return normal.unionByName(two_line).unionByName(non_numeric)


def _instant(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyyMMddHHmmss"), F.lit("000"))


def table_listing(events: DataFrame, prefix: str = TABLE_PREFIX) -> DataFrame:
    """An object listing (path, size, mtime) of a merge-on-read table.

    Timeline: per event hour h a deltacommit (left in flight when hour % 7 = 3),
    a compaction at h+30m when hour % 6 = 0 (completed unless day % 3 = 0) and
    a clean at h+45m when hour % 12 = 5. Data files: one per event by
    event_id % 8 (base, log, partition metadata, checksum, other).
    """
    hours = events.select(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h")).distinct()
    hr, day = F.hour("h"), F.dayofmonth("h")
    d = _instant(F.col("h"))
    c = _instant(F.col("h") + F.expr("INTERVAL 30 MINUTES"))
    k = _instant(F.col("h") + F.expr("INTERVAL 45 MINUTES"))
    comp, cln = hr % 6 == 0, hr % 12 == 5
    names = F.array(
        F.concat(d, F.lit(".deltacommit.requested")), F.concat(d, F.lit(".deltacommit.inflight")),
        F.when(hr % 7 != 3, F.concat(d, F.lit(".deltacommit"))),
        F.when(comp, F.concat(c, F.lit(".compaction.requested"))),
        F.when(comp, F.concat(c, F.lit(".compaction.inflight"))),
        F.when(comp & (day % 3 != 0), F.concat(c, F.lit(".commit"))),
        F.when(cln, F.concat(k, F.lit(".clean.requested"))),
        F.when(cln, F.concat(k, F.lit(".clean.inflight"))),
        F.when(cln, F.concat(k, F.lit(".clean"))),
    )
    tl = f"{prefix}/.hoodie/"
    timeline = hours.select(F.explode(names).alias("name"), "h").filter(F.col("name").isNotNull()).select(
        F.concat(F.lit(tl), "name").alias("path"), F.lit(0).cast("bigint").alias("size"), F.col("h").alias("mtime"))
    first = hours.agg(F.min("h").alias("h"))
    fixed = first.select(F.explode(F.array(
        F.lit(tl + "hoodie.properties"),
        F.concat(F.lit(tl + "archived/"), _instant(F.col("h")), F.lit(".commits_.archive.1")),
    )).alias("path"), F.lit(512).cast("bigint").alias("size"), F.col("h").alias("mtime"))

    e = events.select("event_id", "user_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    m = F.col("event_id") % 8
    part = F.concat(F.lit(prefix + "/dt="), F.date_format("ts", "yyyy-MM-dd"), F.lit("/"))
    fg = F.concat(F.lit("fg"), (F.col("user_id") % 16).cast("string"), F.lit("-0"))
    token = F.concat((F.col("event_id") % 5).cast("string"), F.lit("-"), F.col("event_id").cast("string"), F.lit("-0"))
    inst = _instant(F.date_trunc("hour", "ts"))
    name = (F.when(m.isin(0, 4), F.concat(fg, F.lit("_"), token, F.lit("_"), inst, F.lit(".parquet")))
            .when(m.isin(1, 2, 5), F.concat(F.lit("."), fg, F.lit("_"), inst, F.lit(".log."),
                                            F.col("event_id").cast("string"), F.lit("_"), token))
            .when(m == 3, F.lit(".hoodie_partition_metadata"))
            .when(m == 6, F.concat(F.lit(".checksum_"), F.col("event_id").cast("string"), F.lit(".crc")))
            .otherwise(F.concat(F.lit("notes-"), F.col("event_id").cast("string"), F.lit(".txt"))))
    size = (F.when(m.isin(0, 4), F.floor(F.col("value") * 1000))
            .when(m.isin(1, 2, 5), F.floor(F.col("value") * 100))
            .when(m == 3, F.lit(96)).when(m == 6, F.lit(12))
            .otherwise(F.floor("value"))).cast("bigint")
    data = e.select(F.concat(part, name).alias("path"), size.alias("size"), F.col("ts").alias("mtime"))
    return timeline.unionByName(fixed).unionByName(data)


def component_status(events: DataFrame) -> DataFrame:
    """Per event hour, the observed state of three components (ts, component, state).

    connector: FAILED when hour % 11 = 4; task: missing when hour % 17 = 9,
    FAILED when hour % 13 = 2; mysql: DOWN when hour % 19 = 7; else healthy.
    """
    hours = events.select(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts")).distinct()
    hr = F.hour("ts")
    conn = F.when(hr % 11 == 4, F.lit("FAILED")).otherwise(F.lit("RUNNING"))
    task = (F.when(hr % 17 == 9, F.lit(None).cast("string"))
            .when(hr % 13 == 2, F.lit("FAILED")).otherwise(F.lit("RUNNING")))
    mysql = F.when(hr % 19 == 7, F.lit("DOWN")).otherwise(F.lit("OK"))
    return hours.select("ts", F.explode(F.array(
        F.struct(F.lit("connector").alias("component"), conn.alias("state")),
        F.struct(F.lit("task").alias("component"), task.alias("state")),
        F.struct(F.lit("mysql").alias("component"), mysql.alias("state")),
    )).alias("s")).select("ts", "s.component", "s.state")


def progress_lines(msgs: DataFrame) -> DataFrame:
    """Streaming progress as JSON text, one line per batch (``value`` column).

    Batch b begins b minutes after ``PROGRESS_START`` and reports its duration, input rate, and a broker source whose
    ``endOffset`` is what was consumed after batch b and whose
    ``latestOffset`` is the topic's high watermark.
    """
    from pyspark.sql import Window

    per = msgs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    bp = msgs.groupBy("b", "partition").agg(F.max("offset").alias("mx"))
    w = Window.partitionBy("partition").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    hw = msgs.groupBy("partition").agg((F.max("offset") + 1).alias("hw"))
    run = bp.withColumn("consumed", F.max("mx").over(w) + 1).join(hw, "partition")
    offs = run.groupBy("b").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), "consumed"))).alias("end"),
        F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), "hw"))).alias("latest"))
    src = F.struct(
        F.lit(f"KafkaV2[Subscribe[{TOPIC}]]").alias("description"),
        F.create_map(F.lit(TOPIC), F.col("end")).alias("endOffset"),
        F.create_map(F.lit(TOPIC), F.col("latest")).alias("latestOffset"),
        F.col("n").alias("numInputRows"))
    doc = F.struct(
        F.col("b").alias("batchId"),
        F.date_format(F.timestamp_seconds(F.lit(PROGRESS_START) + 60 * F.col("b")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.struct((F.col("n") * 7).alias("triggerExecution"), (F.col("n") * 5).alias("addBatch")).alias("durationMs"),
        (F.col("n") / F.lit(30.0)).alias("inputRowsPerSecond"),
        F.array(src).alias("sources"),
    )
    return per.join(offs, "b").select(F.to_json(doc).alias("value"))


def hourly_samples(events: DataFrame) -> DataFrame:
    """Hourly counter samples per partition series (FIXTURES.md H).

    ``produced_total``: good events of the series so far that day (a counter
    that resets at midnight); ``acked_total``: the same for view/click
    events. Hours without good events have no sample (gaps), and series
    start at different hours.
    """
    from pyspark.sql import Window

    e = events.filter(message_class(F.col("event_id")) == "good").select(
        (F.col("user_id") % 4).cast("string").alias("p"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h"),
        F.col("event_type").isin("view", "click").cast("int").alias("acked"))
    per = e.groupBy("p", "h").agg(F.count(F.lit(1)).alias("n"), F.sum("acked").alias("a"))
    day = Window.partitionBy("p", F.to_date("h")).orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    cum = per.select("p", "h", F.sum("n").over(day).alias("produced"), F.sum("a").over(day).alias("acked"))
    labels = F.create_map(F.lit("partition"), F.col("p"))
    return cum.select(F.col("h").alias("ts"), labels.alias("labels"), F.explode(F.array(
        F.struct(F.lit("produced_total").alias("metric"), F.col("produced").cast("double").alias("value")),
        F.struct(F.lit("acked_total").alias("metric"), F.col("acked").cast("double").alias("value")),
    )).alias("s")).select("ts", "s.metric", "labels", "s.value")


ENTITIES = 50  # pipelines that the scrape history tells apart


def scrape_history(events: DataFrame) -> DataFrame:
    """Samples of all 22 pipeline metrics and two driver metrics, by pipeline.

    A pipeline (label ``pipeline``, by user) is scraped at each of its events
    (time floored to 15 s), so samples grow with ``events``. Each metric is a
    fixed function of the event; counters grow with ``event_id``. Feeds the
    alert rules and panels end to end. One scan, one explode.
    """
    e = events.select((F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 15) * 15).alias("s"),
                      (F.col("user_id") % ENTITIES).cast("string").alias("pipeline"), "event_id", "value", "user_id")
    t = e.groupBy("s", "pipeline").agg(F.max("event_id").alias("i"), F.max("value").alias("x"), F.max("user_id").alias("u"))
    t = t.withColumn("ts", F.timestamp_seconds("s"))
    hr, day = F.hour("ts"), F.dayofmonth("ts")
    i, x = F.col("i"), F.col("x")
    p = "pipeline_"
    metrics = [
        (p + "kafka_topic_latest_offset", i + 1),
        (p + "kafka_partition_count", F.lit(4)),
        (p + "spark_consumer_lag_total", F.floor(x * 40_000)),
        (p + "spark_last_batch_written", F.floor(i / 10)),
        (p + "hudi_last_commit_age_seconds", (i % 40) * 15),
        (p + "debezium_connector_running", F.when(hr % 11 == 4, 0).otherwise(1)),
        (p + "debezium_task_running", F.when(hr % 13 == 2, 0).otherwise(1)),
        (p + "mysql_reachable", F.when(hr % 19 == 7, 0).otherwise(1)),
        (p + "hudi_deltacommit_count", F.floor(i / 3)),
        (p + "hudi_commit_count", F.when(day <= 3, 0).otherwise(day)),
        (p + "hudi_clean_count", F.floor(i / 12)),
        (p + "hudi_inflight_operations", i % 9),
        (p + "hudi_data_files_total", i % 500),
        (p + "hudi_log_files_total", i % 120),
        (p + "hudi_base_files_total", i % 380),
        (p + "hudi_table_size_bytes", i * 200_000_000),
        (p + "hudi_file_groups_total", F.lit(16)),
        (p + "exporter_scrape_errors_total", F.floor(i / 7)),
        (p + "exporter_last_scrape_timestamp", F.col("s")),
        (p + "exporter_scrape_duration_seconds", x / 100),
        ("metrics_app_app1_driver_spark_streaming_q_triggerExecution_Value", x * 200),
        ("metrics_app_app2_driver_spark_streaming_q_triggerExecution_Value", 120_000 - x * 200),
        ("metrics_app_app1_driver_spark_streaming_q_inputRate_total_Value", x),
    ]
    whole = F.create_map(F.lit("pipeline"), F.col("pipeline"))
    part = F.create_map(F.lit("pipeline"), F.col("pipeline"), F.lit("partition"), (F.col("u") % 4).cast("string"))
    split = [(p + "spark_consumer_lag_per_partition", F.floor(x * 10_000)), (p + "kafka_partition_offset", i + 1)]
    return t.select("ts", F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), labels.alias("labels"), v.cast("double").alias("value"))
        for labels, some in ((whole, metrics), (part, split)) for n, v in some])).alias("s")).select("ts", "s.metric", "s.labels", "s.value")


def scrape_log(events: DataFrame) -> DataFrame:
    """Exporter scrapes per event hour: (ts, errors, duration_s).

    errors = database down + task state missing (failed requests); duration =
    events in the hour / 10 seconds.
    """
    h = events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts")).agg(
        F.count(F.lit(1)).alias("n"))
    hr = F.hour("ts")
    return h.select("ts", ((hr % 19 == 7).cast("int") + (hr % 17 == 9).cast("int")).alias("errors"),
                    (F.col("n") / F.lit(10.0)).alias("duration_s"))
