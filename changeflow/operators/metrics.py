"""The 22 pipeline metrics as one samples DataFrame (§2.12, FN-16).

Every input is a DataFrame; each metric is a one-row (or one-row-per-label)
aggregate, and the results are unpivoted into (ts, metric, labels, value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.sources import listing as L
from changeflow.sources import offsets as O

P = "pipeline_"


def indicator(status: DataFrame, component: str, healthy: str, now: Column) -> DataFrame:
    """FN-16: 1 if the newest state of ``component`` at ``now`` is ``healthy``, else 0
    (a missing or unknown state counts as 0)."""
    latest = status.filter((F.col("component") == component) & (F.col("ts") <= now)).agg(
        F.max_by("state", "ts").alias("state"))
    return latest.select(F.when(F.col("state") == healthy, 1).otherwise(0).alias("value"))


def as_samples(df: DataFrame, now: Column, names: dict[str, str], label: str | None = None) -> DataFrame:
    """Unpivot the columns in ``names`` (column → metric name) into samples."""
    ids = [label] if label else []
    long = df.select(*ids, *[F.col(c).cast("double").alias(n) for c, n in names.items()]).unpivot(
        ids, list(names.values()), "metric", "value")
    labels = (F.create_map(F.lit(label), F.col(label).cast("string")) if label
              else F.create_map().cast("map<string,string>"))
    return long.select(now.alias("ts"), "metric", labels.alias("labels"), "value")


def scrape_totals(scrapes: DataFrame, now: Column) -> DataFrame:
    """M-20..22 from a scrape log (ts, errors, duration_s)."""
    s = scrapes.filter(F.col("ts") <= now)
    return s.agg(F.sum("errors").alias("errors_total"),
                 F.unix_seconds(F.max("ts")).alias("last_scrape_ts"),
                 F.round(F.max_by("duration_s", "ts"), 2).alias("duration_s"))


def scrape_samples(now: Column, scrapes: DataFrame) -> DataFrame:
    """M-20..22 as samples."""
    return as_samples(scrape_totals(scrapes, now), now, {"errors_total": P + "exporter_scrape_errors_total",
                                                         "last_scrape_ts": P + "exporter_last_scrape_timestamp",
                                                         "duration_s": P + "exporter_scrape_duration_seconds"})


def offset_metrics(now: Column, latest: DataFrame, consumed: DataFrame | None) -> list[DataFrame]:
    """M-1..6 from latest offsets (topic, partition, latest_offset) and consumed
    offsets (batch_id, topic, partition, offset)."""
    out = [
        as_samples(O.offset_totals(latest), now, {"latest_total": P + "kafka_topic_latest_offset",
                                                  "partition_count": P + "kafka_partition_count"}),
        as_samples(latest, now, {"latest_offset": P + "kafka_partition_offset"}, label="partition"),
    ]
    if consumed is not None:
        lag = O.consumer_lag(consumed, latest)
        out += [
            as_samples(O.lag_total(lag), now, {"lag_total": P + "spark_consumer_lag_total",
                                               "last_batch_written": P + "spark_last_batch_written"}),
            as_samples(lag, now, {"lag": P + "spark_consumer_lag_per_partition"}, label="partition"),
        ]
    return out


def status_metrics(now: Column, status: DataFrame) -> list[DataFrame]:
    """M-7..9 from a status table (ts, component, state)."""
    return [
        as_samples(indicator(status, "connector", "RUNNING", now), now, {"value": P + "debezium_connector_running"}),
        as_samples(indicator(status, "task", "RUNNING", now), now, {"value": P + "debezium_task_running"}),
        as_samples(indicator(status, "mysql", "OK", now), now, {"value": P + "mysql_reachable"}),
    ]


def table_metrics(now: Column, listing: DataFrame, table_prefix: str, timeline_dir: str = ".hoodie",
                  ignore_names: str | None = None, age_from_mtime: bool = False) -> list[DataFrame]:
    """M-10..19 from an object listing of the table."""
    timeline = L.parse_timeline(listing, f"{table_prefix.rstrip('/')}/{timeline_dir}")
    files = L.classify_files(listing, table_prefix, timeline_dir, ignore_names)
    return [
        as_samples(L.commit_age(timeline, now, age_from_mtime), now,
                   {"commit_age_seconds": P + "hudi_last_commit_age_seconds"}),
        as_samples(L.timeline_counts(timeline), now, {"deltacommit_count": P + "hudi_deltacommit_count",
                                                      "commit_count": P + "hudi_commit_count",
                                                      "clean_count": P + "hudi_clean_count"}),
        as_samples(L.inflight_count(L.timeline_instants(timeline)), now,
                   {"inflight_operations": P + "hudi_inflight_operations"}),
        as_samples(L.file_inventory(files), now, {"data_files_total": P + "hudi_data_files_total",
                                                  "log_files_total": P + "hudi_log_files_total",
                                                  "base_files_total": P + "hudi_base_files_total",
                                                  "table_size_bytes": P + "hudi_table_size_bytes"}),
        as_samples(L.file_groups(files), now, {"file_groups_total": P + "hudi_file_groups_total"}),
    ]


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pipeline_metrics(now: Column, messages: DataFrame, checkpoint_files: DataFrame, topic: str,
                     status: DataFrame, listing: DataFrame, table_prefix: str, scrapes: DataFrame) -> DataFrame:
    """All 22 metrics at ``now`` as samples.

    Fixed values: the metric names (prefix ``pipeline_``) are the
    reference's exported names, so rules and panels written against them work
    unchanged.
    """
    latest = O.latest_offsets(messages).filter(F.col("topic") == topic)
    consumed = O.checkpoint_offsets(checkpoint_files, topic)
    parts = (offset_metrics(now, latest, consumed) + status_metrics(now, status)
             + table_metrics(now, listing, table_prefix)
             + [scrape_samples(now, scrapes)])
    return union_all(parts)
