"""Named metric, time-series, alert and panel queries with oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions import series as S
from changeflow.operators import alerts as A
from changeflow.operators import history as H
from changeflow.operators import metrics as M
from changeflow.operators import panels as PN
from changeflow.operators import sketches as SK
from changeflow.plans.cdc import EV, _events, messages
from changeflow.session import scratch_dir
from changeflow.sources import fixtures as FX
from changeflow.sources import listing as L
from changeflow.sources import offsets as O
from changeflow.sources.progress import latest_from_progress, progress_metrics, progress_offsets, progress_samples
from changeflow.streaming.alerting import AlertEvaluator

NOW = "2024-02-01 00:00:00"
NOW_SQL = f"TIMESTAMP '{NOW}'"
WINDOW = ("2024-01-14 18:10:00", "2024-01-15 18:10:00")
PANEL_WINDOW = ("2024-01-15 12:07:00", "2024-01-15 13:07:00")


def _now():
    # A SQL literal read in the session time zone (UTC), not a Python
    # datetime, which PySpark would convert with the process time zone.
    return F.lit(NOW).cast("timestamp")


def _msgs(spark, sf_dir) -> DataFrame:
    return messages(spark, sf_dir)


def _latest(spark, sf_dir):
    return O.latest_offsets(_msgs(spark, sf_dir))


def _consumed(spark, sf_dir):
    return O.checkpoint_offsets(FX.checkpoint_files(_msgs(spark, sf_dir)), FX.TOPIC)


def _timeline(spark, sf_dir):
    return L.parse_timeline(FX.table_listing(_events(spark, sf_dir)), FX.TABLE_PREFIX + "/.hoodie")


def _files(spark, sf_dir):
    return L.classify_files(FX.table_listing(_events(spark, sf_dir)), FX.TABLE_PREFIX)


def _hourly(spark, sf_dir):
    return S.with_series(FX.hourly_samples(_events(spark, sf_dir)))


def q_offsets_latest(spark, sf_dir):
    return _latest(spark, sf_dir)


def q_offsets_latest_total(spark, sf_dir):
    return O.offset_totals(_latest(spark, sf_dir))


def q_checkpoint_offsets(spark, sf_dir):
    return _consumed(spark, sf_dir)


def q_checkpoint_offsets_committed(spark, sf_dir):
    """X11: consumed offsets from the newest *committed* batch (commits for 3..9)."""
    files = FX.checkpoint_files(_msgs(spark, sf_dir))
    commits = files.select("file_name").filter(F.expr("try_cast(file_name AS INT)") <= 9)
    return O.checkpoint_offsets(O.committed_only(files, commits), FX.TOPIC)


def q_lag_per_partition(spark, sf_dir):
    return O.consumer_lag(_consumed(spark, sf_dir), _latest(spark, sf_dir))


def q_lag_total(spark, sf_dir):
    return O.lag_total(O.consumer_lag(_consumed(spark, sf_dir), _latest(spark, sf_dir)))


def q_lag_two_topics(spark, sf_dir):
    """JOIN-1 where two topics share partition numbers: both consumers' lag, each against its own topic."""
    files = FX.checkpoint_files(_msgs(spark, sf_dir))
    own = O.checkpoint_offsets(files, FX.TOPIC).unionByName(O.checkpoint_offsets(files, FX.OTHER_TOPIC))
    other = _latest(spark, sf_dir).select(F.lit(FX.OTHER_TOPIC).alias("topic"), "partition", (F.col("latest_offset") + 100).alias("latest_offset"))
    return O.consumer_lag(own, _latest(spark, sf_dir).unionByName(other))


def q_timeline_counts(spark, sf_dir):
    return L.timeline_counts(_timeline(spark, sf_dir))


def q_timeline_inflight(spark, sf_dir):
    return L.timeline_instants(_timeline(spark, sf_dir)).select(
        "instant", F.size("suffixes").alias("n_suffixes"), "truly_inflight")


def q_commit_age(spark, sf_dir):
    return L.commit_age(_timeline(spark, sf_dir), _now()).select(
        F.unix_seconds("latest").alias("latest_s"), "commit_age_seconds")


def q_file_inventory(spark, sf_dir):
    return L.file_inventory(_files(spark, sf_dir))


def q_file_groups_over_time(spark, sf_dir):
    """Distinct file groups of each day and of the seven days up to it, merged from one sketch an hour."""
    files = _files(spark, sf_dir).filter(F.col("kind").isin("base", "log"))
    mtime = FX.table_listing(_events(spark, sf_dir)).select("path", "mtime")
    hour = F.floor(F.unix_seconds("mtime") / 3600)
    hourly = SK.sketches(files.join(mtime, "path").withColumn("hour", hour), ["hour"], F.col("file_group"))
    day_end = (F.floor(F.col("hour") / 24) + 1) * 24 - 1  # its last hour
    ends = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda d: day_end + 24 * d)
    week = SK.distinct_in_windows(hourly, "hour", ends, 7 * 24, name="week")
    day = SK.distinct_in_windows(hourly, "hour", F.array(day_end), 24, name="day")
    return day.join(week, "end").select(F.col("end").cast("bigint").alias("last_hour"), "day", "week")


def q_file_groups(spark, sf_dir):
    return L.file_groups(_files(spark, sf_dir))


def q_progress_metrics(spark, sf_dir):
    return progress_metrics(FX.progress_lines(_msgs(spark, sf_dir))).select("batch_id", "trigger_ms", "input_rows_per_second")


def q_progress_samples(spark, sf_dir):
    s = progress_samples(progress_metrics(FX.progress_lines(_msgs(spark, sf_dir))), "app1", "q")
    return s.select(F.unix_seconds("ts").alias("t"), "metric", "value")


def q_progress_offsets(spark, sf_dir):
    return progress_offsets(FX.progress_lines(_msgs(spark, sf_dir)))


def q_progress_latest(spark, sf_dir):
    return latest_from_progress(progress_offsets(FX.progress_lines(_msgs(spark, sf_dir))))


def all_metrics(spark, sf_dir) -> DataFrame:
    ev = _events(spark, sf_dir)
    msgs = _msgs(spark, sf_dir)
    return M.pipeline_metrics(_now(), msgs, FX.checkpoint_files(msgs), FX.TOPIC, FX.component_status(ev),
                              FX.table_listing(ev), FX.TABLE_PREFIX, FX.scrape_log(ev))


def q_metrics_all(spark, sf_dir):
    return all_metrics(spark, sf_dir).select("metric", F.col("labels")["partition"].alias("partition"), "value")


HISTORY_STEP_S = 21_600


def history(spark, sf_dir) -> DataFrame:
    """All 22 metrics of three tables, two topics, two clusters and two exporters, every six hours."""
    ev, msgs = _events(spark, sf_dir), _msgs(spark, sf_dir)
    listing = FX.table_listing(ev)
    part = F.when(F.col("path").contains("/dt="), F.pmod(F.conv(F.substring(F.md5("path"), 1, 8), 16, 10).cast("bigint"), F.lit(3))).otherwise(F.lit(0))
    table = F.concat(F.lit(FX.TABLE_PREFIX + "_"), part.cast("string"))
    listing = listing.select(table.alias("table"), F.concat(table, F.expr(f"substring(path, {len(FX.TABLE_PREFIX) + 1})")).alias("path"), "size", "mtime")
    topics = msgs.select(F.concat(F.col("topic"), F.when(F.col("offset") % 3 == 0, ".b").otherwise(".a")).alias("topic"), "partition", "offset", "timestamp")
    lines = FX.progress_lines(msgs)
    times = progress_metrics(lines).select("batch_id", "ts")
    lags = progress_offsets(lines).join(times, "batch_id")
    status = FX.component_status(ev).withColumn("cluster", F.when(F.hour("ts") % 2 == 0, "c0").otherwise("c1"))
    scrapes = FX.scrape_log(ev).withColumn("exporter", F.when(F.hour("ts") % 3 == 0, "e0").otherwise("e1"))
    return (H.table_history(listing, HISTORY_STEP_S).unionByName(H.offset_history(topics, HISTORY_STEP_S))
            .unionByName(H.lag_history(lags, 60)).unionByName(H.status_history(status, HISTORY_STEP_S))
            .unionByName(H.scrape_history(scrapes, HISTORY_STEP_S)))


def q_metrics_history(spark, sf_dir):
    return S.with_series(history(spark, sf_dir)).select("metric", "series", "t", "value")


def q_ts_increase(spark, sf_dir):
    s = _hourly(spark, sf_dir).filter(F.col("metric") == "produced_total")
    return S.increase(s, 10_800).select("series", "t", "value", "increase")


def q_ts_rate(spark, sf_dir):
    s = _hourly(spark, sf_dir).filter(F.col("metric") == "produced_total")
    return S.increase(s, 10_800).select("series", "t", "rate")


def q_ts_instant(spark, sf_dir):
    s = _hourly(spark, sf_dir).filter(F.col("metric") == "produced_total")
    return S.instant(s, step_s=1800, lookback_s=3600).select("series", "t", "value")


def _rates(spark, sf_dir, r):
    s = _hourly(spark, sf_dir)
    rates = S.increase(s, r).filter(F.col("rate").isNotNull())
    prod = rates.filter(F.col("metric") == "produced_total").select("t", "series", F.col("rate").alias("value"))
    ack = rates.filter(F.col("metric") == "acked_total").select("t", "series", F.col("rate").alias("value"))
    return prod, ack


def q_consumer_rate(spark, sf_dir):
    prod, ack = _rates(spark, sf_dir, 10_800)
    d = S.combine(prod, ack, "-")
    return d.select("series", "t", S.clamp_min(F.col("value"), 0).alias("value"))


def q_lag_minutes(spark, sf_dir):
    prod, ack = _rates(spark, sf_dir, 7_200)
    net = S.combine(prod, ack, "-").withColumn("value", S.clamp_min(F.col("value"), 1))
    level = _hourly(spark, sf_dir).filter(F.col("metric") == "produced_total").select("t", "series", "value")
    q = S.combine(level, net, "/")
    return q.select("series", "t", (F.col("value") / 60).alias("value"))


def q_panel_status(spark, sf_dir):
    s = _hourly(spark, sf_dir).filter(F.col("metric") == "produced_total")
    return s.select("series", "t", "value",
                    PN.threshold_status(F.col("value"), "green", [(20, "yellow"), (50, "red")]).alias("status"))


def _produced_gt(spark, sf_dir, x):
    s = _hourly(spark, sf_dir)
    return s.filter((F.col("metric") == "produced_total") & (F.col("value") > x)).select("t", "series", "value")


def q_alert_hold(spark, sf_dir):
    s = _hourly(spark, sf_dir).filter(F.col("metric") == "produced_total")
    cond = s.select("series", "t", (F.col("value") > 20).alias("active"))
    return S.firing(cond, hold_s=7_200, step_s=3_600, keys=["series"]).select("series", "t", "active_since", "state")


def q_alert_and(spark, sf_dir):
    s = _hourly(spark, sf_dir)
    b = s.filter((F.col("metric") == "acked_total") & (F.col("value") > 10)).select("t", "series")
    return S.and_series(_produced_gt(spark, sf_dir, 20), b).select("series", "t", "value")


def q_alert_and_on(spark, sf_dir):
    s = _hourly(spark, sf_dir)
    b = s.filter((F.col("metric") == "acked_total") & (F.col("value") > 30)).select("t", "series")
    return S.and_series(_produced_gt(spark, sf_dir, 20), b, on=[]).select("series", "t", "value")


def _history(spark, sf_dir):
    return FX.scrape_history(_events(spark, sf_dir))


def q_alerts_all(spark, sf_dir):
    """All 13 rules end to end, as one row per run of a condition."""
    return _runs(A.evaluate(_history(spark, sf_dir)))


def _runs(states: DataFrame) -> DataFrame:
    return states.groupBy("alert", "severity", "component", "metric", "series", "active_since").agg(
        F.max("t").alias("last_t"), F.count(F.lit(1)).alias("n"), F.sum((F.col("state") == "firing").cast("bigint")).alias("n_firing"),
        F.max("value").alias("max_value"))


def _one_rule(spark, sf_dir, name):
    rule = next(r for r in A.RULES if r.name == name)
    return A.evaluate(_history(spark, sf_dir), [rule]).select("alert", "metric", "series", "t", "active_since", "state")


def q_alert_rule_instant(spark, sf_dir):
    """PipelineStalled end to end: instant grid, threshold, 2-minute hold."""
    return _one_rule(spark, sf_dir, "PipelineStalled")


def q_alert_rule_range(spark, sf_dir):
    """ProducerConsumerRateDivergence end to end: rate over 2m at grid times, hold 3m."""
    return _one_rule(spark, sf_dir, "ProducerConsumerRateDivergence")


def q_alert_rule_and(spark, sf_dir):
    """DebeziumTaskFailed end to end: two instant vectors joined by ``and``, hold 1m."""
    return _one_rule(spark, sf_dir, "DebeziumTaskFailed")


def q_alert_window(spark, sf_dir):
    """All rules over one day: the rows that a full evaluation has there."""
    return A.evaluate(_history(spark, sf_dir), start=WINDOW[0], end=WINDOW[1]).select(
        "alert", "metric", "series", "t", "value", "active_since", "state")


SLICE_DAYS = 8


def q_alert_incremental(spark, sf_dir):
    """All rules, evaluated batch by batch as samples come, as one row per run of a condition."""
    history = _history(spark, sf_dir)
    evaluator = AlertEvaluator(scratch_dir(spark, "alerts"))
    day = F.unix_date(F.to_date("ts"))
    first, last, newest = history.agg(F.min(day), F.max(day), F.max(F.unix_seconds("ts"))).first()
    for n, at in enumerate(range(first, last + 1, SLICE_DAYS)):
        until = newest + A.longest_reach(A.RULES) if at + SLICE_DAYS > last else None
        evaluator(history.filter((day >= at) & (day < at + SLICE_DAYS)), n, until)
    return _runs(evaluator.alerts(spark))


def q_panel_lag(spark, sf_dir):
    """Panel 22 end to end: lag on a 15 s grid with its threshold colours."""
    return PN.panel(_history(spark, sf_dir), 22).select("panel", "t", "metric", "series", "value", "status")


def q_panels_all(spark, sf_dir):
    """All 18 panels end to end, as hourly figures for each line, colour and text."""
    return PN.panels(_history(spark, sf_dir)).groupBy("panel", "metric", "series", "status", "text", F.floor(F.col("t") / 3600).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("min_value"), F.max("value").alias("max_value"))


def q_panel_window(spark, sf_dir):
    """All panels over one hour of the dashboard."""
    return PN.panels(_history(spark, sf_dir), start=PANEL_WINDOW[0], end=PANEL_WINDOW[1]).select(
        "panel", "metric", "series", "t", "value", "status", "text")


QUERIES = {
    "offsets_latest": q_offsets_latest,
    "offsets_latest_total": q_offsets_latest_total,
    "checkpoint_offsets": q_checkpoint_offsets,
    "checkpoint_offsets_committed": q_checkpoint_offsets_committed,
    "lag_per_partition": q_lag_per_partition,
    "lag_total": q_lag_total,
    "lag_two_topics": q_lag_two_topics,
    "timeline_counts": q_timeline_counts,
    "timeline_inflight": q_timeline_inflight,
    "commit_age": q_commit_age,
    "file_inventory": q_file_inventory,
    "file_groups": q_file_groups,
    "file_groups_over_time": q_file_groups_over_time,
    "progress_metrics": q_progress_metrics,
    "progress_samples": q_progress_samples,
    "progress_offsets": q_progress_offsets,
    "progress_latest": q_progress_latest,
    "metrics_all": q_metrics_all,
    "metrics_history": q_metrics_history,
    "ts_increase": q_ts_increase,
    "ts_rate": q_ts_rate,
    "ts_instant": q_ts_instant,
    "consumer_rate": q_consumer_rate,
    "lag_minutes": q_lag_minutes,
    "panel_status": q_panel_status,
    "alert_hold": q_alert_hold,
    "alert_and": q_alert_and,
    "alert_and_on": q_alert_and_on,
    "alert_rule_instant": q_alert_rule_instant,
    "alert_rule_range": q_alert_rule_range,
    "alert_rule_and": q_alert_rule_and,
    "alerts_all": q_alerts_all,
    "alert_window": q_alert_window,
    "alert_incremental": q_alert_incremental,
    "panel_lag": q_panel_lag,
    "panels_all": q_panels_all,
    "panel_window": q_panel_window,
}

# ---------------------------------------------------------------------------
# DuckDB oracles

TOPIC = FX.TOPIC
HOURS = "hours AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events)"
LATEST = "latest AS (SELECT part, max(event_id) + 1 AS lo FROM ev GROUP BY part)"
CONSUMED = """consumed AS (SELECT CAST(part AS VARCHAR) AS partition, max(event_id) + 1 AS co FROM ev
             WHERE b <= 7 GROUP BY part UNION ALL SELECT '99', 5)"""
LAG = f"""lagp AS (SELECT '{TOPIC}' AS topic, c.partition, 10 AS batch_id, greatest(0, coalesce(l.lo, 0) - c.co) AS lag
        FROM consumed c LEFT JOIN latest l ON CAST(l.part AS VARCHAR) = c.partition)"""
INSTANTS = """inst AS (
  SELECT strftime(h, '%Y%m%d%H%M%S') || '000' AS instant, CASE WHEN hour(h) % 7 = 3 THEN 2 ELSE 3 END AS n_suffixes,
         hour(h) % 7 = 3 AS truly_inflight, CASE WHEN hour(h) % 7 <> 3 THEN h END AS done_at FROM hours
  UNION ALL
  SELECT strftime(h + INTERVAL 30 MINUTE, '%Y%m%d%H%M%S') || '000', CASE WHEN day(h) % 3 = 0 THEN 2 ELSE 3 END,
         day(h) % 3 = 0, CASE WHEN day(h) % 3 <> 0 THEN h + INTERVAL 30 MINUTE END FROM hours WHERE hour(h) % 6 = 0
  UNION ALL
  SELECT strftime(h + INTERVAL 45 MINUTE, '%Y%m%d%H%M%S') || '000', 3, false, NULL FROM hours WHERE hour(h) % 12 = 5)"""
FILES = """files AS (
  SELECT event_id % 8 AS m, user_id,
         CASE WHEN event_id % 8 IN (0, 4) THEN CAST(floor(value * 1000) AS BIGINT)
              WHEN event_id % 8 IN (1, 2, 5) THEN CAST(floor(value * 100) AS BIGINT)
              WHEN event_id % 8 = 3 THEN 96 WHEN event_id % 8 = 6 THEN 12
              ELSE CAST(floor(value) AS BIGINT) END AS size
  FROM events)"""
TIMELINE_COUNTS = """SELECT count(*) FILTER (WHERE hour(h) % 7 <> 3) AS deltacommit_count,
       count(*) FILTER (WHERE hour(h) % 6 = 0 AND day(h) % 3 <> 0) AS commit_count,
       count(*) FILTER (WHERE hour(h) % 12 = 5) AS clean_count FROM hours"""
COMMIT_AGE = f"""SELECT CAST(epoch(max(done_at)) AS BIGINT) AS latest_s,
       CAST(epoch({NOW_SQL}) - epoch(max(done_at)) AS BIGINT) AS commit_age_seconds FROM inst"""
FILE_INV = """SELECT count(*) FILTER (WHERE m <> 3) AS data_files_total,
       count(*) FILTER (WHERE m IN (0, 4)) AS base_files_total,
       count(*) FILTER (WHERE m IN (1, 2, 5, 6)) AS log_files_total,
       CAST(sum(size) FILTER (WHERE m <> 3) AS BIGINT) AS table_size_bytes FROM files"""
FILE_GROUPS = """SELECT count(DISTINCT CASE WHEN m IN (0, 1, 2, 4, 5) THEN 'fg' || CAST(user_id % 16 AS VARCHAR) || '-0'
                                WHEN m = 6 THEN 'checksum' END) AS file_groups_total FROM files"""
HOURLY = """hs AS (SELECT CAST(user_id % 4 AS VARCHAR) AS p, date_trunc('hour', ts) AS h, count(*) AS n,
                 count(*) FILTER (WHERE event_type IN ('view', 'click')) AS a
          FROM ev WHERE cls = 'good' GROUP BY 1, 2),
s AS (SELECT 'partition=' || p AS series, CAST(epoch(h) AS BIGINT) AS t,
             CAST(sum(n) OVER (PARTITION BY p, CAST(h AS DATE) ORDER BY h ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS produced,
             CAST(sum(a) OVER (PARTITION BY p, CAST(h AS DATE) ORDER BY h ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS acked
      FROM hs)"""


def _rate_cte(name: str, col: str, r: int) -> str:
    return f"""{name}_d AS (SELECT series, t, {col} AS v,
        CASE WHEN lag({col}) OVER w IS NULL THEN 0 WHEN {col} >= lag({col}) OVER w THEN {col} - lag({col}) OVER w
             ELSE {col} END AS d FROM s WINDOW w AS (PARTITION BY series ORDER BY t)),
{name} AS (SELECT series, t, v, CASE WHEN count(*) OVER f >= 2 THEN sum(d) OVER f - first_value(d) OVER f END AS increase,
        CASE WHEN count(*) OVER f >= 2 THEN (sum(d) OVER f - first_value(d) OVER f) / (t - first_value(t) OVER f) END AS rate
        FROM {name}_d WINDOW f AS (PARTITION BY series ORDER BY t RANGE BETWEEN {r - 1} PRECEDING AND CURRENT ROW))"""


def _w(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


METRICS_ALL = _w(EV, HOURS, LATEST, CONSUMED, LAG, INSTANTS, FILES,
                 "lasth AS (SELECT max(h) AS h FROM hours)",
                 "scr AS (SELECT h, (hour(h) % 19 = 7)::INT + (hour(h) % 17 = 9)::INT AS errors FROM hours)",
                 "lastn AS (SELECT count(*) AS n FROM events, lasth WHERE date_trunc('hour', ts) = lasth.h)") + f"""
SELECT 'pipeline_kafka_topic_latest_offset' AS metric, NULL AS partition, CAST(sum(lo) AS DOUBLE) AS value FROM latest
UNION ALL SELECT 'pipeline_kafka_partition_count', NULL, CAST(count(*) AS DOUBLE) FROM latest
UNION ALL SELECT 'pipeline_kafka_partition_offset', CAST(part AS VARCHAR), CAST(lo AS DOUBLE) FROM latest
UNION ALL SELECT 'pipeline_spark_consumer_lag_total', NULL, CAST(sum(lag) AS DOUBLE) FROM lagp
UNION ALL SELECT 'pipeline_spark_last_batch_written', NULL, 10.0
UNION ALL SELECT 'pipeline_spark_consumer_lag_per_partition', partition, CAST(lag AS DOUBLE) FROM lagp
UNION ALL SELECT 'pipeline_debezium_connector_running', NULL, CASE WHEN hour(h) % 11 = 4 THEN 0.0 ELSE 1.0 END FROM lasth
UNION ALL SELECT 'pipeline_debezium_task_running', NULL,
          CASE WHEN hour(h) % 17 = 9 OR hour(h) % 13 = 2 THEN 0.0 ELSE 1.0 END FROM lasth
UNION ALL SELECT 'pipeline_mysql_reachable', NULL, CASE WHEN hour(h) % 19 = 7 THEN 0.0 ELSE 1.0 END FROM lasth
UNION ALL SELECT 'pipeline_hudi_last_commit_age_seconds', NULL, CAST(commit_age_seconds AS DOUBLE) FROM ({COMMIT_AGE})
UNION ALL SELECT 'pipeline_hudi_deltacommit_count', NULL, CAST(deltacommit_count AS DOUBLE) FROM ({TIMELINE_COUNTS})
UNION ALL SELECT 'pipeline_hudi_commit_count', NULL, CAST(commit_count AS DOUBLE) FROM ({TIMELINE_COUNTS})
UNION ALL SELECT 'pipeline_hudi_clean_count', NULL, CAST(clean_count AS DOUBLE) FROM ({TIMELINE_COUNTS})
UNION ALL SELECT 'pipeline_hudi_inflight_operations', NULL, CAST(count(*) FILTER (WHERE truly_inflight) AS DOUBLE) FROM inst
UNION ALL SELECT 'pipeline_hudi_data_files_total', NULL, CAST(data_files_total AS DOUBLE) FROM ({FILE_INV})
UNION ALL SELECT 'pipeline_hudi_log_files_total', NULL, CAST(log_files_total AS DOUBLE) FROM ({FILE_INV})
UNION ALL SELECT 'pipeline_hudi_base_files_total', NULL, CAST(base_files_total AS DOUBLE) FROM ({FILE_INV})
UNION ALL SELECT 'pipeline_hudi_table_size_bytes', NULL, CAST(table_size_bytes AS DOUBLE) FROM ({FILE_INV})
UNION ALL SELECT 'pipeline_hudi_file_groups_total', NULL, CAST(file_groups_total AS DOUBLE) FROM ({FILE_GROUPS})
UNION ALL SELECT 'pipeline_exporter_scrape_errors_total', NULL, CAST(sum(errors) AS DOUBLE) FROM scr
UNION ALL SELECT 'pipeline_exporter_last_scrape_timestamp', NULL, CAST(epoch(h) AS DOUBLE) FROM lasth
UNION ALL SELECT 'pipeline_exporter_scrape_duration_seconds', NULL, round(n / 10.0, 2) FROM lastn"""

# Alerts and panels over the scrape history: each rule's values by an as-of
# join and a range join on its own grid, and its runs by gaps.

_HOUR = "hour(make_timestamp(s * 1000000))"
_DAY = "day(make_timestamp(s * 1000000))"
SAMPLES_SQL = {
    "kafka_topic_latest_offset": "i + 1", "spark_consumer_lag_total": "floor(x * 40000)", "hudi_last_commit_age_seconds": "(i % 40) * 15",
    "debezium_connector_running": f"CASE WHEN {_HOUR} % 11 = 4 THEN 0 ELSE 1 END",
    "debezium_task_running": f"CASE WHEN {_HOUR} % 13 = 2 THEN 0 ELSE 1 END", "mysql_reachable": f"CASE WHEN {_HOUR} % 19 = 7 THEN 0 ELSE 1 END",
    "hudi_deltacommit_count": "floor(i / 3.0)", "hudi_commit_count": f"CASE WHEN {_DAY} <= 3 THEN 0 ELSE {_DAY} END",
    "hudi_clean_count": "floor(i / 12.0)", "hudi_inflight_operations": "i % 9", "hudi_log_files_total": "i % 120",
    "hudi_base_files_total": "i % 380", "hudi_table_size_bytes": "i * 200000000", "exporter_scrape_errors_total": "floor(i / 7.0)",
}
APPS_SQL = {"metrics_app_app1_driver_spark_streaming_q_triggerExecution_Value": "x * 200",
            "metrics_app_app2_driver_spark_streaming_q_triggerExecution_Value": "120000 - x * 200",
            "metrics_app_app1_driver_spark_streaming_q_inputRate_total_Value": "x"}
TICKS = f"""ticks AS (SELECT (epoch_us(ts) // 1000000) // 15 * 15 AS s, CAST(user_id % {FX.ENTITIES} AS VARCHAR) AS pipeline,
       max(event_id) AS i, max(value) AS x, max(user_id) AS u FROM events GROUP BY 1, 2)"""
SAMPLES = "samples AS (" + "\nUNION ALL ".join(
    f"SELECT '{m}' AS metric, 'pipeline=' || pipeline AS series, s AS t, CAST({e} AS DOUBLE) AS v FROM ticks"
    for m, e in [*((A.P + k, e) for k, e in SAMPLES_SQL.items()), *APPS_SQL.items()]) + f"""
UNION ALL SELECT '{A.P}spark_consumer_lag_per_partition', 'partition=' || (u % 4) || ',pipeline=' || pipeline, s, CAST(floor(x * 10000) AS DOUBLE) FROM ticks)"""
DELTAS = """deltas AS (SELECT *, CASE WHEN lag(v) OVER w IS NULL THEN 0 WHEN v >= lag(v) OVER w THEN v - lag(v) OVER w ELSE v END AS d
       FROM samples WINDOW w AS (PARTITION BY metric, series ORDER BY t))"""


def _value_sql(v: A.Value, step: int) -> str:
    """(metric, series, t, value) of one value on its grid."""
    mine = f"regexp_full_match(metric, '{v.metric}')" if v.regex else f"metric = '{v.metric}'"
    reach = v.reach(A.LOOKBACK_S)
    grid = f"""(SELECT DISTINCT metric, series, unnest(range(CAST(ceil(t / {step}.0) * {step} AS BIGINT), t + {reach} + 1, {step})) AS t
        FROM samples WHERE {mine})"""
    if v.fn == "instant":
        return f"""SELECT g.metric, g.series, g.t, d.v AS value FROM {grid} g ASOF JOIN (SELECT * FROM deltas WHERE {mine}) d
        ON g.metric = d.metric AND g.series = d.series AND g.t >= d.t"""
    value = "sum(d.d) - arg_min(d.d, d.t)"
    if v.fn == "rate":
        value = f"({value}) / (max(d.t) - min(d.t))"
    return f"""SELECT g.metric, g.series, g.t, {value} AS value FROM {grid} g JOIN (SELECT * FROM deltas WHERE {mine}) d
        ON g.metric = d.metric AND g.series = d.series AND d.t > g.t - {v.range_s} AND d.t <= g.t GROUP BY ALL HAVING count(*) >= 2"""


def _term_sql(t: A.Term) -> str:
    op = {"==": "=", "!=": "<>"}.get(t.op, t.op)
    return f"SELECT * FROM ({_value_sql(t.value, A.EVAL_STEP_S)}) WHERE value {op} {t.limit}"


def _rule_sql(r: A.Rule) -> str:
    also = ""
    if r.also is not None:
        on = "b.t = a.t" if r.on_time else "b.t = a.t AND b.series = a.series"
        also = f" WHERE EXISTS (SELECT 1 FROM ({_term_sql(r.also)}) b WHERE {on})"
    return f"""SELECT '{r.name}' AS alert, '{r.severity}' AS severity, '{r.component}' AS component, {r.hold_s} AS hold, a.*
      FROM ({_term_sql(r.term)}) a{also}"""


def alerts_sql(rules) -> str:
    """CTEs up to ``states``: every active row of the rules with its run's start and state."""
    return _w(TICKS, SAMPLES, DELTAS, "active AS (" + "\nUNION ALL ".join(map(_rule_sql, rules)) + ")",
              f"""starts AS (SELECT *, CASE WHEN coalesce(t - lag(t) OVER w > {A.EVAL_STEP_S}, true) THEN t END AS begin
                   FROM active WINDOW w AS (PARTITION BY alert, metric, series ORDER BY t))""",
              "runs AS (SELECT *, max(begin) OVER (PARTITION BY alert, metric, series ORDER BY t ROWS UNBOUNDED PRECEDING) AS active_since FROM starts)",
              "states AS (SELECT *, CASE WHEN t - active_since >= hold THEN 'firing' ELSE 'pending' END AS state FROM runs)")


def _one_rule_sql(name: str) -> str:
    return alerts_sql([r for r in A.RULES if r.name == name]) + "SELECT alert, metric, series, t, active_since, state FROM states"


def _panel_sql(p: PN.Panel) -> str:
    parts = []
    for line in p.lines:
        values = [_value_sql(v, PN.PANEL_STEP_S) for v in line.values]
        if line.of is None:
            name = f"'{line.legend}'" if line.legend else "metric"
            parts.append(f"SELECT {name} AS metric, series, t, value FROM ({values[0]})")
        elif len(values) == 2:
            parts.append(f"""SELECT '{line.legend}' AS metric, a.series, a.t, greatest(a.value - b.value, 0) AS value
            FROM ({values[0]}) a JOIN ({values[1]}) b USING (series, t)""")
        else:
            parts.append(f"""SELECT '{line.legend}' AS metric, a.series, a.t, a.value / greatest(b.value - c.value, 1) / 60 AS value
            FROM ({values[0]}) a JOIN ({values[1]}) b USING (series, t) JOIN ({values[2]}) c USING (series, t)""")
    steps = "".join(f"WHEN value >= {x} THEN '{c}' " for x, c in reversed(p.steps))
    status = f"CASE {steps}ELSE '{p.base}' END" if p.base else "NULL"
    text = "CASE value " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in p.mapping.items()) + " END" if p.mapping else "NULL"
    return f"""SELECT {p.pid} AS panel, metric, series, t, value, CAST({status} AS VARCHAR) AS status, CAST({text} AS VARCHAR) AS text
      FROM ({' UNION ALL '.join(parts)})"""


def panels_sql(specs) -> str:
    return _w(TICKS, SAMPLES, DELTAS, "shown AS (" + "\nUNION ALL ".join(map(_panel_sql, specs)) + ")")


def _within(window: tuple[str, str]) -> str:
    return f"t BETWEEN epoch(TIMESTAMP '{window[0]}') AND epoch(TIMESTAMP '{window[1]}')"


def _each(values: dict[str, str], series: str, source: str) -> str:
    return "\nUNION ALL ".join(f"SELECT '{A.P}{m}' AS metric, {series} AS series, t, CAST({v} AS DOUBLE) AS value FROM {source}" for m, v in values.items())


_S = HISTORY_STEP_S
METRICS_HISTORY = _w(
    EV, HOURS, INSTANTS, f"tick(t) AS (SELECT unnest(range(0, 4000000000, {_S})))".replace("0, 4000000000", "1704000000 // 21600 * 21600, 1709000000"),
    # The listing: one row for each object, with its table, time, size and kind.
    f"""objects AS (
  SELECT 0 AS tb, h AS m, 0 AS size, CASE WHEN hour(h) % 7 <> 3 THEN 'deltacommit' ELSE 'pending' END AS kind, NULL AS g, h AS committed FROM hours
  UNION ALL SELECT 0, h, 0, CASE WHEN day(h) % 3 <> 0 THEN 'commit' ELSE 'pending' END, NULL, h + INTERVAL 30 MINUTE FROM hours WHERE hour(h) % 6 = 0
  UNION ALL SELECT 0, h, 0, 'clean', NULL, NULL FROM hours WHERE hour(h) % 12 = 5
  UNION ALL SELECT ('0x' || substr(md5(path), 1, 8))::BIGINT % 3, ts, size, kind, g, NULL FROM (
    SELECT *, '{FX.TABLE_PREFIX}/dt=' || strftime(ts, '%Y-%m-%d') || '/' || name AS path FROM (
      SELECT ts, CASE WHEN event_id % 8 IN (0, 4) THEN floor(value * 1000) WHEN event_id % 8 IN (1, 2, 5) THEN floor(value * 100)
                      WHEN event_id % 8 = 6 THEN 12 ELSE floor(value) END::BIGINT AS size,
             CASE WHEN event_id % 8 IN (0, 4) THEN 'base' WHEN event_id % 8 = 7 THEN 'other' ELSE 'log' END AS kind,
             CASE WHEN event_id % 8 = 6 THEN 'checksum' WHEN event_id % 8 <> 7 THEN 'fg' || user_id % 16 || '-0' END AS g,
             CASE WHEN event_id % 8 IN (0, 4) THEN 'fg' || user_id % 16 || '-0_' || event_id % 5 || '-' || event_id || '-0_' || strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') || '000.parquet'
                  WHEN event_id % 8 IN (1, 2, 5) THEN '.fg' || user_id % 16 || '-0_' || strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') || '000.log.' || event_id || '_' || event_id % 5 || '-' || event_id || '-0'
                  WHEN event_id % 8 = 6 THEN '.checksum_' || event_id || '.crc' ELSE 'notes-' || event_id || '.txt' END AS name
      FROM events WHERE event_id % 8 <> 3)))""",
    f"""seen AS (SELECT tb, ceil(epoch_us(m) / {_S}e6)::BIGINT * {_S} AS k, * EXCLUDE (tb) FROM objects
      UNION ALL SELECT ('0x' || substr(md5('{FX.TABLE_PREFIX}/dt=' || strftime(ts, '%Y-%m-%d') || '/.hoodie_partition_metadata'), 1, 8))::BIGINT % 3,
                ceil(epoch_us(ts) / {_S}e6)::BIGINT * {_S}, ts, 0, 'none', NULL, NULL FROM events WHERE event_id % 8 = 3""" + ")",
    "span AS (SELECT tb, min(k) AS lo, (SELECT max(k) FROM seen) AS hi FROM seen GROUP BY tb)",
    """tables AS (SELECT tb, t, count(*) FILTER (kind = 'deltacommit') AS dc, count(*) FILTER (kind = 'commit') AS cc, count(*) FILTER (kind = 'clean') AS cl,
       count(*) FILTER (kind = 'pending') AS inflight, count(*) FILTER (kind IN ('base', 'log', 'other')) AS files, count(*) FILTER (kind = 'log') AS logs,
       count(*) FILTER (kind = 'base') AS bases, coalesce(sum(size) FILTER (kind IN ('base', 'log', 'other')), 0) AS bytes, count(DISTINCT g) AS groups,
       coalesce(t - max(epoch(committed)::BIGINT) FILTER (kind IN ('deltacommit', 'commit')), -1) AS age
     FROM tick JOIN span ON t BETWEEN lo AND hi JOIN seen USING (tb) WHERE k <= t GROUP BY tb, t)""",
    f"""offs AS (SELECT '{TOPIC}' || CASE WHEN event_id % 3 = 0 THEN '.b' ELSE '.a' END AS topic, user_id % 4 AS part,
         ceil(epoch_us(ts) / {_S}e6)::BIGINT * {_S} AS k, event_id + 1 AS o FROM events)""",
    """parts AS (SELECT topic, part, t, max(o) AS o FROM tick JOIN offs ON k <= t WHERE t <= (SELECT max(k) FROM offs) GROUP BY topic, part, t)""",
    "topics AS (SELECT topic, t, sum(o) AS o, count(*) AS n FROM parts GROUP BY topic, t)",
    "hw AS (SELECT part, max(event_id) + 1 AS hw FROM ev GROUP BY part)",
    "bp AS (SELECT b, part, max(event_id) + 1 AS mx FROM ev GROUP BY b, part)",
    f"""lags AS (SELECT x.b, x.part, {FX.PROGRESS_START} + 60 * x.b AS t, greatest(0, hw - (SELECT max(mx) FROM bp y WHERE y.part = x.part AND y.b <= x.b)) AS lag
       FROM bp x JOIN hw USING (part))""",
    "lagt AS (SELECT t, sum(lag) AS lag, max(b) AS b FROM lags GROUP BY t)",
    f"""states AS (SELECT h, ceil(epoch_us(h) / {_S}e6)::BIGINT * {_S} AS k, CASE WHEN hour(h) % 2 = 0 THEN 'c0' ELSE 'c1' END AS c,
       CASE WHEN hour(h) % 11 = 4 THEN 0 ELSE 1 END AS conn, CASE WHEN hour(h) % 17 = 9 OR hour(h) % 13 = 2 THEN 0 ELSE 1 END AS task,
       CASE WHEN hour(h) % 19 = 7 THEN 0 ELSE 1 END AS mysql FROM hours)""",
    """statt AS (SELECT c, t, arg_max(conn, h) AS conn, arg_max(task, h) AS task, arg_max(mysql, h) AS mysql
       FROM tick JOIN states ON k <= t WHERE t <= (SELECT max(k) FROM states) GROUP BY c, t)""",
    f"""scr AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1)""",
    f"""scrk AS (SELECT h, ceil(epoch_us(h) / {_S}e6)::BIGINT * {_S} AS k, CASE WHEN hour(h) % 3 = 0 THEN 'e0' ELSE 'e1' END AS e,
       (hour(h) % 19 = 7)::INT + (hour(h) % 17 = 9)::INT AS errors, n / 10.0 AS took FROM scr)""",
    """scrt AS (SELECT e, t, sum(errors) AS errors, epoch(max(h))::BIGINT AS last_s, round(arg_max(took, h), 2) AS took
       FROM tick JOIN scrk ON k <= t WHERE t <= (SELECT max(k) FROM scrk) GROUP BY e, t)""",
) + "\nUNION ALL ".join([
    _each({"hudi_last_commit_age_seconds": "age", "hudi_deltacommit_count": "dc", "hudi_commit_count": "cc", "hudi_clean_count": "cl",
           "hudi_inflight_operations": "inflight", "hudi_data_files_total": "files", "hudi_log_files_total": "logs", "hudi_base_files_total": "bases",
           "hudi_table_size_bytes": "bytes", "hudi_file_groups_total": "groups"}, f"'table={FX.TABLE_PREFIX}_' || tb", "tables"),
    _each({"kafka_topic_latest_offset": "o", "kafka_partition_count": "n"}, "'topic=' || topic", "topics"),
    _each({"kafka_partition_offset": "o"}, "'partition=' || part || ',topic=' || topic", "parts"),
    _each({"spark_consumer_lag_total": "lag", "spark_last_batch_written": "b"}, f"'topic={TOPIC}'", "lagt"),
    _each({"spark_consumer_lag_per_partition": "lag"}, f"'partition=' || part || ',topic={TOPIC}'", "lags"),
    _each({"debezium_connector_running": "conn", "debezium_task_running": "task", "mysql_reachable": "mysql"}, "'cluster=' || c", "statt"),
    _each({"exporter_scrape_errors_total": "errors", "exporter_last_scrape_timestamp": "last_s", "exporter_scrape_duration_seconds": "took"}, "'exporter=' || e", "scrt"),
])

ORACLE = {
    "metrics_history": METRICS_HISTORY,
    "offsets_latest": _w(EV) + f"SELECT '{TOPIC}' AS topic, part AS partition, max(event_id) + 1 AS latest_offset FROM ev GROUP BY part",
    "offsets_latest_total": _w(EV, LATEST) + f"SELECT '{TOPIC}' AS topic, sum(lo) AS latest_total, count(*) AS partition_count FROM latest",
    "checkpoint_offsets": _w(EV, CONSUMED) + f"SELECT 10 AS batch_id, '{TOPIC}' AS topic, partition, co AS offset FROM consumed",
    "checkpoint_offsets_committed": _w(EV) + f"""SELECT 9 AS batch_id, '{TOPIC}' AS topic, CAST(part AS VARCHAR) AS partition,
       max(event_id) + 1 AS offset FROM ev WHERE b <= 6 GROUP BY part
UNION ALL SELECT 9, '{TOPIC}', '99', 5""",
    "lag_per_partition": _w(EV, LATEST, CONSUMED, LAG) + "SELECT topic, partition, batch_id, lag FROM lagp",
    "lag_total": _w(EV, LATEST, CONSUMED, LAG) + "SELECT topic, sum(lag) AS lag_total, max(batch_id) AS last_batch_written FROM lagp GROUP BY topic",
    "lag_two_topics": _w(EV, LATEST, CONSUMED, LAG) + f"""SELECT topic, partition, batch_id, lag FROM lagp
UNION ALL SELECT '{FX.OTHER_TOPIC}', '0', 10, (SELECT lo + 100 - 42 FROM latest WHERE part = 0)""",
    "timeline_counts": _w(HOURS) + TIMELINE_COUNTS,
    "timeline_inflight": _w(HOURS, INSTANTS) + "SELECT instant, n_suffixes, truly_inflight FROM inst",
    "commit_age": _w(HOURS, INSTANTS) + COMMIT_AGE,
    "file_inventory": _w(FILES) + FILE_INV,
    "file_groups": _w(FILES) + FILE_GROUPS,
    "file_groups_over_time": """WITH g AS (
  SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) // 86400 AS d,
         CASE WHEN event_id % 8 = 6 THEN 'checksum' ELSE 'fg' || (user_id % 16) END AS fg FROM events WHERE event_id % 8 IN (0, 1, 2, 4, 5, 6)),
days AS (SELECT DISTINCT d FROM g)
SELECT days.d * 24 + 23 AS last_hour, count(DISTINCT fg) FILTER (g.d = days.d) AS day, count(DISTINCT fg) AS week
FROM days JOIN g ON g.d BETWEEN days.d - 6 AND days.d GROUP BY days.d""",
    "progress_metrics": """SELECT event_id % 10 AS batch_id, count(*) * 7 AS trigger_ms, count(*) / 30.0 AS input_rows_per_second
FROM events GROUP BY 1""",
    "progress_samples": _w("p AS (SELECT event_id % 10 AS b, count(*) AS n FROM events GROUP BY 1)") + """
SELECT 1706745600 + 60 * b AS t, 'metrics_app_app1_driver_spark_streaming_q_triggerExecution_Value' AS metric, CAST(n * 7 AS DOUBLE) AS value FROM p
UNION ALL SELECT 1706745600 + 60 * b, 'metrics_app_app1_driver_spark_streaming_q_inputRate_total_Value', n / 30.0 FROM p""",
    "progress_offsets": _w(EV, "bp AS (SELECT b, part, max(event_id) AS mx FROM ev GROUP BY b, part)",
                           "hw AS (SELECT part, max(event_id) + 1 AS hw FROM ev GROUP BY part)") + f"""
SELECT bb.b AS batch_id, '{TOPIC}' AS topic, CAST(bb.part AS VARCHAR) AS partition,
       (SELECT max(mx) FROM bp WHERE bp.part = bb.part AND bp.b <= bb.b) + 1 AS end_offset, hw.hw AS latest_offset,
       greatest(0, hw.hw - ((SELECT max(mx) FROM bp WHERE bp.part = bb.part AND bp.b <= bb.b) + 1)) AS lag
FROM bp bb JOIN hw USING (part)""",
    "progress_latest": _w(EV) + f"""SELECT '{TOPIC}' AS topic, CAST(part AS VARCHAR) AS partition,
       max(event_id) + 1 AS latest_offset FROM ev GROUP BY part""",
    "metrics_all": METRICS_ALL,
    "ts_increase": _w(EV, HOURLY, _rate_cte("r", "produced", 10_800)) + "SELECT series, t, v AS value, increase FROM r",
    "ts_rate": _w(EV, HOURLY, _rate_cte("r", "produced", 10_800)) + "SELECT series, t, rate FROM r",
    "ts_instant": _w(EV, HOURLY, """b AS (SELECT series, min(t) AS t0, max(t) AS t1 FROM s GROUP BY series)""",
                     """g AS (SELECT series, unnest(range(CAST(ceil(t0 / 1800.0) * 1800 AS BIGINT), t1 + 3600 + 1, 1800)) AS t FROM b)""",
                     """u AS (SELECT series, t, produced AS v, false AS is_grid FROM s
                             UNION ALL SELECT series, t, NULL, true FROM g)""",
                     """x AS (SELECT series, t, is_grid, last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY t
                             RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS v FROM u)""")
    + "SELECT series, t, v AS value FROM x WHERE is_grid AND v IS NOT NULL",
    "consumer_rate": _w(EV, HOURLY, _rate_cte("rp", "produced", 10_800), _rate_cte("ra", "acked", 10_800))
    + """SELECT rp.series, rp.t, greatest(rp.rate - ra.rate, 0) AS value FROM rp JOIN ra USING (series, t)
WHERE rp.rate IS NOT NULL AND ra.rate IS NOT NULL""",
    "lag_minutes": _w(EV, HOURLY, _rate_cte("rp", "produced", 7_200), _rate_cte("ra", "acked", 7_200))
    + """SELECT rp.series, rp.t, rp.v / greatest(rp.rate - ra.rate, 1) / 60 AS value FROM rp JOIN ra USING (series, t)
WHERE rp.rate IS NOT NULL AND ra.rate IS NOT NULL""",
    "panel_status": _w(EV, HOURLY) + """SELECT series, t, produced AS value,
       CASE WHEN produced >= 50 THEN 'red' WHEN produced >= 20 THEN 'yellow' ELSE 'green' END AS status FROM s""",
    "alert_hold": _w(EV, HOURLY, "c AS (SELECT series, t, produced > 20 AS active FROM s)",
                     """st AS (SELECT *, CASE WHEN active AND (lag(t) OVER w IS NULL OR NOT lag(active) OVER w
                                   OR t - lag(t) OVER w > 3600) THEN t END AS start
                              FROM c WINDOW w AS (PARTITION BY series ORDER BY t))""",
                     "r AS (SELECT *, max(start) OVER (PARTITION BY series ORDER BY t ROWS UNBOUNDED PRECEDING) AS since FROM st)")
    + """SELECT series, t, since AS active_since,
       CASE WHEN t - since >= 7200 THEN 'firing' ELSE 'pending' END AS state FROM r WHERE active""",
    "alert_rule_instant": _one_rule_sql("PipelineStalled"),
    "alert_rule_range": _one_rule_sql("ProducerConsumerRateDivergence"),
    "alert_rule_and": _one_rule_sql("DebeziumTaskFailed"),
    "alerts_all": alerts_sql(A.RULES) + """SELECT alert, severity, component, metric, series, active_since, max(t) AS last_t, count(*) AS n,
       count(*) FILTER (state = 'firing') AS n_firing, max(value) AS max_value FROM states GROUP BY ALL""",
    "alert_incremental": alerts_sql(A.RULES) + """SELECT alert, severity, component, metric, series, active_since, max(t) AS last_t, count(*) AS n,
       count(*) FILTER (state = 'firing') AS n_firing, max(value) AS max_value FROM states GROUP BY ALL""",
    "alert_window": alerts_sql(A.RULES) + f"SELECT alert, metric, series, t, value, active_since, state FROM states WHERE {_within(WINDOW)}",
    "panel_lag": panels_sql([p for p in PN.PANELS if p.pid == 22]) + "SELECT panel, t, metric, series, value, status FROM shown",
    "panels_all": panels_sql(PN.PANELS) + """SELECT panel, metric, series, status, text, t // 3600 AS hour, count(*) AS n,
       min(value) AS min_value, max(value) AS max_value FROM shown GROUP BY ALL""",
    "panel_window": panels_sql(PN.PANELS) + f"SELECT panel, metric, series, t, value, status, text FROM shown WHERE {_within(PANEL_WINDOW)}",
    "alert_and": _w(EV, HOURLY) + """SELECT series, t, produced AS value FROM s
WHERE produced > 20 AND acked > 10""",
    "alert_and_on": _w(EV, HOURLY) + """SELECT series, t, produced AS value FROM s
WHERE produced > 20 AND t IN (SELECT t FROM s WHERE acked > 30)""",
}
