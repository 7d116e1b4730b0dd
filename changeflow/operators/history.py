"""The pipeline metrics of several entities at every sample time (§2.12 with key and history).

``metrics.pipeline_metrics`` answers for one table at one moment; here every
input carries an entity (table, topic or cluster) and a time, and each metric
has a value at every tick: what holds of all rows up to that time. An input is
reduced to changes per (entity, tick) in one grouped sum, and running sums and
maxima over the ticks give the values, so rows are read once and no step holds
more than the ticks of one entity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.operators.metrics import P
from changeflow.sources import listing as L


def tick_of(ts: Column, step_s: int) -> Column:
    """The first tick at which a row of this time counts."""
    return (F.ceil(F.unix_micros(ts) / F.lit(step_s * 1_000_000)) * step_s).cast("bigint")


def running(changes: DataFrame, keys: list[str], step_s: int, sums: list[str] = (), maxima: list[str] = ()) -> DataFrame:
    """(keys, tick, sums, maxima) at every tick from a key's first change to the last change of all.

    ``sums`` add up over all earlier changes, ``maxima`` are the largest so far.
    """
    per = changes.groupBy(*keys, "tick").agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxima])
    spans = per.groupBy(*keys).agg(F.min("tick").alias("first"), F.max("tick").alias("last"))  # one row for a key
    spans = spans.withColumn("end", F.max("last").over(Window.partitionBy(F.lit(0))))
    ticks = spans.select(*keys, F.explode(F.sequence("first", "end", F.lit(step_s).cast("bigint"))).alias("tick"))
    w = Window.partitionBy(*keys).orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    return ticks.join(per, [*keys, "tick"], "left").select(
        *keys, "tick", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(c) for c in sums], *[F.max(c).over(w).alias(c) for c in maxima])


def samples_of(values: DataFrame, names: dict[str, str], labels: dict[str, str]) -> DataFrame:
    """Columns as samples (ts, metric, labels, value); ``names`` maps columns to metrics, ``labels`` label names to columns."""
    tags = F.create_map(*[x for k, c in labels.items() for x in (F.lit(k), F.col(c).cast("string"))])
    each = F.array(*[F.struct(F.lit(P + m).alias("metric"), F.col(c).cast("double").alias("value")) for c, m in names.items()])
    rows = values.select(F.timestamp_seconds("tick").alias("ts"), tags.alias("labels"), F.explode(each).alias("s"))
    return rows.select("ts", "s.metric", "labels", "s.value").filter(F.col("value").isNotNull())


def _zeros(*names: str) -> list[Column]:
    return [F.lit(0).cast("bigint").alias(n) for n in names]


def table_history(listing: DataFrame, step_s: int, timeline_dir: str = ".hoodie") -> DataFrame:
    """M-10..19 of every table in a listing (table, path, size, mtime); ``table`` is the table's path prefix."""
    rest = F.expr("substring(path, length(table) + 2)")
    timeline = rest.startswith(f"{timeline_dir}/") & ~F.substring(rest, len(timeline_dir) + 2, 1 << 30).contains("/")
    name = L.base_name(F.col("path"))
    rows = listing.select("table", "size", tick_of(F.col("mtime"), step_s).alias("tick"), name.alias("name"), timeline.alias("on_timeline"),
                          (~F.col("path").contains(f"/{timeline_dir}/") & (name != ".hoodie_partition_metadata")).alias("is_file"))
    rows = rows.select("*", F.substring_index("name", ".", 1).alias("instant"), F.expr("substring(name, length(substring_index(name, '.', 1)) + 2)").alias("suffix"))
    rows = rows.withColumn("action", F.col("on_timeline") & F.col("name").contains(".") & F.col("instant").rlike("^[0-9]+$"))
    kind = F.when(F.col("name").startswith("."), "log").when(F.col("name").endswith(".parquet"), "base").otherwise("other")
    group = F.when(kind != "other", F.nullif(F.regexp_extract("name", r"^\.?([^_]+)_", 1), F.lit("")))
    counts = {"deltacommits": "deltacommit", "commits": "commit", "cleans": "clean"}
    plain = [*counts, "data_files", "log_files", "base_files", "bytes"]

    def n(when: Column) -> Column:
        return when.cast("bigint")

    direct = rows.select("table", "tick", *[n(F.col("action") & (F.col("suffix") == s)).alias(c) for c, s in counts.items()],
                         n(F.col("is_file")).alias("data_files"), n(F.col("is_file") & (kind == "log")).alias("log_files"),
                         n(F.col("is_file") & (kind == "base")).alias("base_files"), F.when(F.col("is_file"), F.col("size")).otherwise(0).alias("bytes"),
                         *_zeros("inflight", "groups"),
                         F.when(F.col("action") & F.col("suffix").isin("deltacommit", "commit"), F.unix_seconds(L.instant_time(F.col("instant")))).alias("committed"))
    # An instant is in flight from its first pending marker until its first completed one.
    pending = F.col("suffix").endswith("inflight") | F.col("suffix").endswith("requested")
    spans = rows.filter("action").groupBy("table", "instant").agg(
        F.min(F.when(pending, F.col("tick"))).alias("begun"), F.min(F.when(F.col("suffix").isin(*L.COMPLETED_SUFFIXES), F.col("tick"))).alias("done"))
    spans = spans.filter("begun is not null and (done is null or done > begun)")
    turns = spans.select("table", F.explode(F.array(F.struct(F.col("begun").alias("tick"), F.lit(1).cast("bigint").alias("d")),
                                                    F.struct(F.col("done").alias("tick"), F.lit(-1).cast("bigint").alias("d")))).alias("x"))
    none = F.lit(None).cast("bigint").alias("committed")
    turns = turns.filter("x.tick is not null").select("table", "x.tick", *_zeros(*plain), F.col("x.d").alias("inflight"), *_zeros("groups"), none)
    groups = rows.filter("is_file").select("table", "tick", group.alias("g")).filter("g is not null").groupBy("table", "g").agg(F.min("tick").alias("tick"))
    groups = groups.select("table", "tick", *_zeros(*plain, "inflight"), F.lit(1).cast("bigint").alias("groups"), none)
    values = running(direct.unionByName(turns).unionByName(groups), ["table"], step_s, [*plain, "inflight", "groups"], ["committed"])
    values = values.withColumn("age", F.coalesce(F.col("tick") - F.col("committed"), F.lit(-1)))
    return samples_of(values, {"age": "hudi_last_commit_age_seconds", "deltacommits": "hudi_deltacommit_count", "commits": "hudi_commit_count",
                               "cleans": "hudi_clean_count", "inflight": "hudi_inflight_operations", "data_files": "hudi_data_files_total",
                               "log_files": "hudi_log_files_total", "base_files": "hudi_base_files_total", "bytes": "hudi_table_size_bytes",
                               "groups": "hudi_file_groups_total"}, {"table": "table"})


def offset_history(messages: DataFrame, step_s: int) -> DataFrame:
    """M-1..3 of every topic from its messages (topic, partition, offset, timestamp)."""
    rows = messages.select("topic", "partition", tick_of(F.col("timestamp"), step_s).alias("tick"), (F.col("offset") + 1).alias("latest"))
    parts = running(rows, ["topic", "partition"], step_s, maxima=["latest"])
    totals = parts.groupBy("topic", "tick").agg(F.sum("latest").alias("latest"), F.count(F.lit(1)).alias("partitions"))
    return samples_of(totals, {"latest": "kafka_topic_latest_offset", "partitions": "kafka_partition_count"}, {"topic": "topic"}).unionByName(
        samples_of(parts, {"latest": "kafka_partition_offset"}, {"topic": "topic", "partition": "partition"}))


def lag_history(progress: DataFrame, step_s: int) -> DataFrame:
    """M-4..6 of every topic from progress records (topic, partition, batch_id, ts, lag): the newest record up to each tick."""
    rows = progress.select("topic", "partition", tick_of(F.col("ts"), step_s).alias("tick"), F.struct("ts", "batch_id", "lag").alias("newest"))
    parts = running(rows, ["topic", "partition"], step_s, maxima=["newest"]).select("topic", "partition", "tick", "newest.lag", "newest.batch_id")
    totals = parts.groupBy("topic", "tick").agg(F.sum("lag").alias("lag"), F.max("batch_id").alias("batch_id"))
    return samples_of(totals, {"lag": "spark_consumer_lag_total", "batch_id": "spark_last_batch_written"}, {"topic": "topic"}).unionByName(
        samples_of(parts, {"lag": "spark_consumer_lag_per_partition"}, {"topic": "topic", "partition": "partition"}))


# Each component's healthy state and its metric.
HEALTHY = {"connector": ("RUNNING", "debezium_connector_running"), "task": ("RUNNING", "debezium_task_running"), "mysql": ("OK", "mysql_reachable")}


def status_history(status: DataFrame, step_s: int) -> DataFrame:
    """M-7..9 of every cluster (cluster, component, ts, state): 1 where the newest state up to a tick is healthy."""
    rows = status.select("cluster", "component", tick_of(F.col("ts"), step_s).alias("tick"), F.struct("ts", "state").alias("newest"))
    states = running(rows, ["cluster", "component"], step_s, maxima=["newest"])
    parts = [samples_of(states.filter(F.col("component") == c).select("cluster", "tick", F.coalesce(F.col("newest.state") == ok, F.lit(False)).cast("int").alias("v")),
                        {"v": m}, {"cluster": "cluster"}) for c, (ok, m) in HEALTHY.items()]
    return reduce(DataFrame.unionByName, parts)


def scrape_history(scrapes: DataFrame, step_s: int) -> DataFrame:
    """M-20..22 of every exporter from its scrape log (exporter, ts, errors, duration_s)."""
    rows = scrapes.select("exporter", tick_of(F.col("ts"), step_s).alias("tick"), "errors", F.struct("ts", "duration_s").alias("newest"))
    values = running(rows, ["exporter"], step_s, ["errors"], ["newest"]).select(
        "exporter", "tick", "errors", F.unix_seconds("newest.ts").alias("at"), F.round("newest.duration_s", 2).alias("took"))
    return samples_of(values, {"errors": "exporter_scrape_errors_total", "at": "exporter_last_scrape_timestamp",
                               "took": "exporter_scrape_duration_seconds"}, {"exporter": "exporter"})
